"""Token counts by a count-only Viterbi pass over a unigram vocabulary.

Aho-Corasick lists every vocabulary piece in a word by its end, longest first; the pass keeps for each
end the best score and the number of pieces of the best path, and no path.  The ties follow the
tokenizer: pieces are tried by start, and only a strictly better score replaces an earlier one.  Words
begin at blanks, so a word's count is the same wherever it stands and is kept while memory allows.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import map_batches

DEFAULT_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MAX_PIECES = 2_000_000
BLANK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value: an unknown character scores the worst piece less this
KEPT_WORDS = 1_000_000
KEPT_LENGTH = 64        # longer words are counted anew each time, so memory stays bounded


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.get_piece_size() > MAX_PIECES:
        raise ValueError("vocabulary too large to ship to the tasks")
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts the pieces of texts; an unknown character counts its UTF-8 bytes when ``byte_pieces``."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_pieces: bool = True):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.longest = max((len(piece) for piece, _ in vocabulary), default=1) or 1
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.byte_pieces = byte_pieces
        self.kept: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Pieces of the best segmentation of one word.

        A place needs the best scores of the last places only, as many as the longest piece has
        characters, so those are held in a ring however long the word.
        """
        ring = self.longest + 1
        best, count = [0.0] * ring, [0] * ring
        loose = [False] * ring  # the best path's last piece is an unknown character
        matches = self.automaton.iter(word)
        ahead = next(matches, None)
        for end, character in enumerate(word):
            score = None
            single = False
            at = end % ring
            while ahead is not None and ahead[0] == end:
                length, weight = ahead[1]
                start = (end + 1 - length) % ring
                total = weight + best[start]
                if score is None or total > score:
                    score, pieces = total, count[start] + 1
                    unknown = False
                single = single or length == 1
                ahead = next(matches, None)
            if not single:
                total = self.unknown + best[at]
                if score is None or total > score:
                    score, unknown = total, True
                    more = len(character.encode("utf-8", "replace")) if self.byte_pieces else 0 if loose[at] else 1
                    pieces = count[at] + more
            place = (end + 1) % ring
            best[place], count[place], loose[place] = score, pieces, unknown
        return count[len(word) % ring]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        marked = text.replace(" ", BLANK)
        first, *rest = marked.split(BLANK)
        kept, total = self.kept, 0
        if first:
            rest.append(first)
        for w in rest:
            n = kept.get(w)
            if n is None:
                n = self.word(BLANK + w)
                if len(w) <= KEPT_LENGTH:
                    if len(kept) >= KEPT_WORDS:
                        kept.clear()
                    kept[w] = n
            total += n
        return total


def token_counts(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, key: str = "doc_id", text: str = "text",
                 byte_pieces: bool = True) -> DataFrame:
    """(key, n_tokens, n_chars) of every row's whole text under the unigram vocabulary.

    Null and empty texts have no tokens; texts and words of any length are counted whole in bounded memory.
    Repeated rows are counted each; other columns, whatever their names, are not read; an empty table gives no rows.
    """
    pieces = read_vocabulary(vocabulary)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))

    def run(batches):
        counter = Counter(pieces, byte_pieces)
        for batch in batches:
            texts = batch.column("t").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.array([counter.text(t) for t in texts], pa.int64()),
                 pa.array([len(t or "") for t in texts], pa.int64())], ["k", "n_tokens", "n_chars"])

    return rows.mapInArrow(run, f"k {kind}, n_tokens bigint, n_chars bigint").withColumnRenamed("k", key)
