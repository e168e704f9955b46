"""License scanning: Aho-Corasick over words, a shunting-yard parser for license expressions."""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import as_bytes, map_batches

# Words are runs of digits, a-z and anything beyond ASCII, after A-Z became lower case; every other
# ASCII character parts them.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

TAG = "spdx license identifier"
TAG_TEXT = re.compile(r"(?i)spdx-license-identifier\s*:\s*((?:(?!spdx-license-identifier|\*/|--!?>|\*\)|[\n\r]).)*)")

# Names of licenses, as words, and what their identifiers start with.
NAMES = {
    "mit license": "MIT", "expat license": "MIT", "isc license": "ISC", "zlib license": "Zlib",
    "boost software license": "BSL", "apache license": "Apache", "apache software license": "Apache",
    "bsd license": "BSD", "bsd 2 clause": "BSD-2-Clause", "2 clause bsd": "BSD-2-Clause", "simplified bsd": "BSD-2-Clause",
    "bsd 3 clause": "BSD-3-Clause", "3 clause bsd": "BSD-3-Clause", "revised bsd": "BSD-3-Clause",
    "mozilla public license": "MPL", "eclipse public license": "EPL", "artistic license": "Artistic",
    "european union public licence": "EUPL", "common development and distribution license": "CDDL",
    "general public license": "GPL", "gnu general public license": "GPL", "gnu gpl": "GPL",
    "lesser general public license": "LGPL", "gnu lesser general public license": "LGPL", "gnu lgpl": "LGPL",
    "library general public license": "LGPL", "gnu library general public license": "LGPL",
    "affero general public license": "AGPL", "gnu affero general public license": "AGPL", "gnu agpl": "AGPL",
    "gpl": "GPL", "lgpl": "LGPL", "agpl": "AGPL", "mpl": "MPL", "epl": "EPL", "cc0": "CC0",
    "cc by": "CC-BY", "cc by sa": "CC-BY-SA", "cc by nd": "CC-BY-ND", "cc by nc": "CC-BY-NC",
    "cc by nc sa": "CC-BY-NC-SA", "cc by nc nd": "CC-BY-NC-ND",
    "creative commons attribution": "CC-BY",
    "creative commons attribution sharealike": "CC-BY-SA", "creative commons attribution share alike": "CC-BY-SA",
    "creative commons attribution noderivatives": "CC-BY-ND", "creative commons attribution no derivatives": "CC-BY-ND",
    "creative commons attribution noncommercial": "CC-BY-NC", "creative commons attribution non commercial": "CC-BY-NC",
    "creative commons attribution noncommercial sharealike": "CC-BY-NC-SA",
    "creative commons attribution noncommercial noderivatives": "CC-BY-NC-ND",
}
# Names too short to mean a license unless a version follows.
SHORT = {"gpl", "lgpl", "agpl", "mpl", "epl", "cc0"}
# Families whose identifiers say whether later versions may be chosen.
LATER = {"GPL", "LGPL", "AGPL"}
# Identifiers that carry no version.
PLAIN_NAMES = {"MIT", "ISC", "Zlib", "BSD", "BSD-2-Clause", "BSD-3-Clause"}

# How the texts of common licenses begin.
BODIES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "MIT",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "ISC",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted": "ISC",
    "redistribution and use in source and binary forms with or without modification are permitted": "BSD-2-Clause",
    "permission is hereby granted free of charge to any person or organization obtaining a copy": "BSL-1.0",
    "this software is provided as is without any express or implied warranty in no event will the authors be held liable": "Zlib",
    "this is free and unencumbered software released into the public domain": "Unlicense",
}
# A further condition that makes the two-clause text the three-clause one.
NO_ENDORSEMENT = "neither the name of"
# The public domain: given up by its owner, or only spoken of.
DOMAIN, DOMAIN_LABEL = "public domain", "public-domain"
GIVEN = ("released into the", "placed in the", "placed into the", "dedicated to the", "dedicate this work to the", "donated to the")
NOT_WORD = re.compile(r"[^A-Za-z0-9]+")
VERSION = re.compile(r"v?([0-9]{1,2})$")
MOST_BETWEEN = 12  # words from a name to its version, when the word "version" tells it
# Words that may stand between two notices joined by OR or AND.
LINK = {"or", "and", "the", "a", "an", "either", "under", "of", "at", "your", "option", "license", "licence", "terms", "by", "both"}

# How freely a text may be used, by the start of its license's identifier in lower case; the longest wins.
FREEDOM = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "zlib": 1.0, "unlicense": 1.0, "bsl": 1.0, "cc0": 1.0,
    "public-domain": 1.0, "cc-by": 0.9, "artistic": 0.8, "cddl": 0.7, "eupl": 0.6,
    "cc-by-sa": 0.6, "cc-by-nd": 0.3, "cc-by-nc": 0.2, "mpl": 0.7, "epl": 0.7, "lgpl": 0.6, "gpl": 0.4, "agpl": 0.3,
}
UNKNOWN = 0.5      # no notice, or a license the table does not know
RESERVED = 0.0     # all rights reserved and nothing granted
EXCEPTION = 0.2    # what an exception (WITH) adds

RANK = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
# In a tag everything but blanks counts, so that whatever is no part of an expression ends it.
TAG_TOKEN = re.compile(r"[()]|[^\s()]+")
QUOTES = "\"'`<"
TRAILING = re.compile(r"[^A-Za-z0-9+]+$")
LIKELY = re.compile(r"[0-9-]")  # what sets an identifier apart from the prose after OR or AND
OPERAND = re.compile(r"(?=.*[A-Za-z0-9])[A-Za-z0-9.+:-]+")


def freedom(license_id: str) -> float:
    name = license_id.lower()
    best = max((p for p in FREEDOM if name == p or name.startswith(p + "-")), key=len, default=None)
    return FREEDOM[best] if best else UNKNOWN


def parse(expression: str) -> list[str] | None:
    """Postfix form by shunting-yard (WITH before AND before OR); None when it is not an expression."""
    return parse_tokens(TOKEN.findall(expression))


def parse_tokens(tokens: list[str]) -> list[str] | None:
    out, waiting, operand = [], [], True
    for token in tokens:
        word = token.lower()
        if token == "(":
            if not operand:
                return None
            waiting.append(token)
        elif token == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting or operand:
                return None
            waiting.pop()
        elif word in RANK:
            if operand:
                return None
            while waiting and waiting[-1] != "(" and RANK[waiting[-1]] >= RANK[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand = True
        else:
            if not operand:
                return None
            out.append(token)
            operand = False
    if operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def parse_tag(rest: str) -> list[str] | None:
    """Postfix form of the longest expression among the first tokens of a tag's line; None without one.

    The tokens end where no expression can go on: at an operand after an operand, at a token that is
    none of theirs, after a mark of punctuation; then a plain word after OR or AND is prose unless
    the table knows it as a license.  A line that ends unfinished (``MIT OR``) holds none.
    """
    tokens, ends, depth, operand, whole = [], [], 0, True, True
    for raw in TAG_TOKEN.findall(rest):
        token = raw if raw in "()" else TRAILING.sub("", raw.lstrip(QUOTES))
        joins = token.lower() in RANK
        if token in ("(", ")"):
            ok = operand if token == "(" else not operand and depth > 0
        else:
            ok = not operand if joins else operand and OPERAND.fullmatch(token)
        if not ok:
            whole = False
            break
        tokens.append(token)
        depth += (token == "(") - (token == ")")
        operand = token == "(" or joins
        if not operand and not depth and (not ends or token == ")" or LIKELY.search(token) or freedom(token) != UNKNOWN):
            ends.append(len(tokens))
        if raw not in "()" and TRAILING.search(raw):
            whole = False
            break
    if whole:
        return parse_tokens(tokens)
    return parse_tokens(tokens[:ends[-1]]) if ends else None


def evaluate(postfix: list[str]) -> tuple[float, list[str]]:
    """(freedom, identifiers): OR leaves the choice, AND binds to the stricter, WITH eases."""
    stack = []
    for token in postfix:
        if token in RANK:
            right, left = stack.pop(), stack.pop()
            value = {"or": max(left[0], right[0]), "and": min(left[0], right[0]),
                     "with": min(1.0, left[0] + EXCEPTION)}[token]
            stack.append((value, left[1] + right[1]))
        else:
            stack.append((freedom(token), [token.lower()]))
    return stack[0]


# --- notices --------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Notice:
    """An identifier and the words it was read from, first and past the last."""

    name: str
    start: int
    end: int


def version_at(words: list[str], at: int) -> tuple[str | None, int]:
    """A version in the words from ``at``, major and minor, and where it ends."""
    while at < len(words) and words[at] in ("version", "v", "ver"):
        at += 1
    found = VERSION.match(words[at]) if at < len(words) else None
    if not found:
        return None, at
    minor = words[at + 1] if at + 1 < len(words) and re.fullmatch("[0-9]", words[at + 1]) else None
    return f"{found[1]}.{minor or 0}", at + (2 if minor else 1)


def version_near(words: list[str], start: int, end: int) -> tuple[str | None, int]:
    """The version a name goes with: right after it, after ``version`` further on, or before ``of the``."""
    version, past = version_at(words, end + (words[end:end + 1] == ["license"]))
    if version:
        return version, past
    for at in range(end, min(len(words), end + MOST_BETWEEN)):
        if words[at] == "version":
            version, past = version_at(words, at)
            if version:
                return version, past
    for back in (start - 1, start - 2):  # version 2 of the
        if words[max(0, back - 1):back + 1] == ["of", "the"] or back >= 0 and words[back] == "of":
            for at in range(max(0, back - 4), back):
                if words[at] in ("version", "v", "ver") or VERSION.match(words[at]) and words[at].startswith("v"):
                    version, _ = version_at(words, at)
                    if version:
                        return version, end
    return None, end


def later_allowed(words: list[str], at: int) -> tuple[bool, int]:
    """Whether ``or any later version`` or the like follows a version, and where that ends."""
    while at < len(words) and words[at] in ("of", "the", "license", "licence", "gnu", "gpl", "lgpl", "agpl"):
        at += 1
    if at < len(words) and words[at] == "or":
        for end in range(at + 1, min(len(words), at + 8)):
            if words[end] in ("later", "newer", "higher", "above"):
                return True, end + 1 + (words[end + 1:end + 2] in (["version"], ["versions"]))
    return words[at:at + 1] == ["plus"], at


def notice_of(name: str, words: list[str], start: int, end: int) -> Notice | None:
    """The identifier of a license name: no version where none is said, no short name without one."""
    family = NAMES[name]
    if family in PLAIN_NAMES:
        return Notice(family, start, end)
    version, past = version_near(words, start, end)
    if version is None:
        return None if name in SHORT else Notice(family, start, end)
    if family in LATER:
        later, past_later = later_allowed(words, past)
        return Notice(f"{family}-{version}-{'or-later' if later else 'only'}", start, past_later if later else past)
    return Notice(f"{family}-{version}", start, past)


def joined(notices: list[Notice], words: list[str]) -> list[list[str]]:
    """Notices as expressions: those linked by a single ``or`` or ``and`` make one."""
    out: list[list[str]] = []
    for i, n in enumerate(notices):
        between = words[notices[i - 1].end:n.start] if i else []
        link = [w for w in between if w in ("or", "and")]
        if i and len(link) == 1 and len(between) <= 8 and set(between) <= LINK:
            out[-1] += [link[0], n.name]
        else:
            out.append([n.name])
    return out


def finder() -> ahocorasick.Automaton:
    """All phrases as whole words between blanks."""
    automaton = ahocorasick.Automaton()
    glued = {f"{family}v{n}" for family in ("gpl", "lgpl", "agpl") for n in (1, 2, 3)}
    for phrase in {*BASE, *NAMES, *BODIES, *glued, NO_ENDORSEMENT, DOMAIN, TAG}:
        automaton.add_word(f" {phrase} ", phrase)
    automaton.make_automaton()
    return automaton


def notices_in(hits: list[tuple[int, str]], words: list[str]) -> list[Notice]:
    """Names and bodies among (first word, phrase), the longest where they overlap."""
    found, past = [], -1
    endorsed = any(p == NO_ENDORSEMENT for _, p in hits)
    for start, phrase in sorted(hits, key=lambda h: (h[0], -len(h[1]))):
        end = start + phrase.count(" ") + 1
        if start < past:
            continue
        made = None
        if phrase in BODIES:
            name = BODIES[phrase]
            made = Notice("BSD-3-Clause" if name == "BSD-2-Clause" and endorsed else name, start, end)
        elif phrase in NAMES:
            made = notice_of(phrase, words, start, end)
        elif phrase not in BASE and phrase[:-2] in SHORT and phrase[-2] == "v":
            minor = words[end:end + 1] in (["0"], ["1"])
            later, _ = later_allowed(words, end + minor)
            version = f"{phrase[-1]}.{words[end] if minor else 0}"
            made = Notice(f"{NAMES[phrase[:-2]]}-{version}-{'or-later' if later else 'only'}", start, end + minor)
        if made:
            found.append(made)
            past = made.end
    return found


def outside_tags(hits: list[tuple[int, str]], tags: list[int], parsed: list[list[str] | None]) -> list[tuple[int, str]]:
    """Hits that are no words of a tag's expression; ``tags`` are the words after each tag's own."""
    sizes = [sum(len(NOT_WORD.sub(" ", t).split()) for t in p or ()) for p in parsed]
    if len(sizes) != len(tags):  # a tag's words without its colon
        sizes = [max(sizes, default=0)] * len(tags)
    taken = [(at, at + n) for at, n in zip(tags, sizes)]
    out, i = [], 0
    for start, phrase in sorted(hits):
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if i == len(taken) or start < taken[i][0]:
            out.append((start, phrase))
    return out


def domain_in(hits: list[tuple[int, str]], words: list[str]) -> tuple[bool, bool]:
    """(spoken of, given): whether the public domain is named without a ``not`` before, and given into."""
    spoken = given = False
    for start, phrase in hits:
        if phrase == DOMAIN:
            before = " ".join(words[max(0, start - 5):start])
            spoken |= "not" not in before.split()
            given |= before.endswith(GIVEN)
    return spoken, given and spoken


def examine(text: bytes | None, automaton: ahocorasick.Automaton) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score) of one text."""
    words = text.translate(PLAIN).split() if text else []
    line = " " + b" ".join(words).decode("utf-8", "replace") + " "
    hits = [(end - len(phrase) - 1, phrase) for end, phrase in automaton.iter(line)]
    blanks = [i for i, c in enumerate(line) if c == " "] if hits else []
    hits = [(bisect_left(blanks, start), phrase) for start, phrase in hits]
    places = [start for start, phrase in hits if phrase in BASE]
    labels = {BASE[p] for _, p in hits if p in BASE}
    found, values = set(labels), []
    if hits:
        plain = line.split(" ")[1:-1]
        tags = [start + TAG.count(" ") + 1 for start, p in hits if p == TAG]
        parsed = [parse_tag(rest) for rest in TAG_TEXT.findall(text.decode("utf-8", "replace"))] if tags else []
        free = outside_tags(hits, tags, parsed)
        parsed += [parse_tokens(e) for e in joined(notices_in(free, plain), plain)]
        spoken, given = domain_in(hits, plain)
        if spoken:
            found.add(DOMAIN_LABEL)
        if given:
            values.append(freedom(DOMAIN_LABEL))
        for postfix in parsed:
            if postfix:
                value, names = evaluate(postfix)
                values.append(value)
                found.update(names)
    score = min(values) if values else RESERVED if "reserved" in labels else UNKNOWN
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
            ",".join(sorted(found)), score)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score) of every whole text.

    ``labels`` adds to the base labels the identifiers of tags and notices; ``score`` is how freely the
    strictest of them lets the text be used: 1 freely, 0 not at all, 0.5 where nothing is said.  A null
    text is empty.  A tag is read up to a comment's end, the next tag or
    the first token that cannot belong to its expression; one without an expression adds nothing.  A notice is a
    license's name with the version and ``or later`` that go with it, or the start of a license's text.  Texts of any
    length are read whole, repeated rows are scanned each, other columns, whatever their names, are not read; an
    empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        automaton = finder()
        found = zip(*[examine(t, automaton) for t in as_bytes(batch, "t")])
        return pa.RecordBatch.from_arrays(
            [batch.column("k"), *[pa.array(c, t) for c, t in zip(found, types)]], ["k", *names])

    schema = (f"k {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
              "labels string, score double")
    return map_batches(rows, run, schema).withColumnRenamed("k", key)
