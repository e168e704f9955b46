import re

import pytest

from cardwarden.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    hits = [(i, label) for phrase, label in licenses.BASE.items() for n in [len(phrase.split())]
            for i in range(len(words)) if words[i:i + n] == phrase.split()]
    places = [i for i, _ in hits]
    return (len(words), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits})))


def check(df):
    rows = {r.doc_id: r.text for r in df.collect()}
    for r in licenses.scan(df).collect():
        assert tuple(r)[1:6] == brute(rows[r.doc_id]), rows[r.doc_id]
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_base_on_documents(spark, sample_docs):
    check(sample_docs)


def test_base_on_edges(spark):
    texts = [None, "", "CC BY", "cc-by cc BY", "cc by cc by cc", "x cc\nby. all-rights_reserved", "xcc by", "cc byé", "é cc by",
             "all rights reserved " * 20_000, "general public\tlicense\x00general PUBLIC license", "cc by", "©all rights reserved"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert licenses.scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("expression, value, names", [
    ("MIT", 1.0, ["mit"]), ("MIT OR GPL-3.0-only", 1.0, ["mit", "gpl-3.0-only"]), ("MIT AND GPL-3.0-only", 0.4, ["mit", "gpl-3.0-only"]),
    ("GPL-2.0-only WITH Classpath-exception-2.0", 0.6000000000000001, ["gpl-2.0-only", "classpath-exception-2.0"]),
    ("MIT or Apache-2.0 and AGPL-3.0-only", 1.0, ["mit", "apache-2.0", "agpl-3.0-only"]),
    ("(MIT OR Apache-2.0) AND AGPL-3.0-only", 0.3, ["mit", "apache-2.0", "agpl-3.0-only"]), ("CC-BY-NC-4.0", 0.2, ["cc-by-nc-4.0"])])
def test_expressions(expression, value, names):
    assert licenses.evaluate(licenses.parse(expression)) == (value, names)


@pytest.mark.parametrize("bad", ["", "MIT OR", "OR MIT", "(MIT", "MIT)", "MIT Apache-2.0", "()", "MIT (ISC)", "AND"])
def test_no_expressions(bad):
    assert licenses.parse(bad) is None


def test_tags_and_notices():
    a = licenses.finder()
    text = b"# SPDX-License-Identifier: (MIT OR GPL-2.0-only)\nReleased under the Apache License, Version 2.0. All rights reserved."
    n, base, first, last, base_labels, labels, score = licenses.examine(text, a)
    assert (base, base_labels, labels, score) == (1, "reserved", "apache-2.0,gpl-2.0-only,mit,reserved", 1.0)
    assert licenses.examine(b"All rights reserved.", a)[-1] == 0.0 and licenses.examine(b"prose", a)[-1] == 0.5
    assert licenses.examine(b"SPDX-License-Identifier: MIT OR", a)[5:] == ("", 0.5)


@pytest.mark.parametrize("line, labels, score", [
    ("<!-- SPDX-License-Identifier: MIT -->", "mit", 1.0), ("/* SPDX-License-Identifier: GPL-2.0-only */", "gpl-2.0-only", 0.4),
    ("SPDX-License-Identifier: MIT This file is part of a library.", "mit", 1.0), ("(* SPDX-License-Identifier: MIT *)", "mit", 1.0),
    ("SPDX-License-Identifier: MIT OR GPL-2.0-only WITH Classpath-exception-2.0. See there", "classpath-exception-2.0,gpl-2.0-only,mit", 1.0),
    ("SPDX-License-Identifier: MIT SPDX-License-Identifier: GPL-3.0-only", "gpl-3.0-only,mit", 0.4),
    ("SPDX-License-Identifier: (MIT OR ISC) and -- more", "isc,mit", 1.0), ("[//]: # (SPDX-License-Identifier: MIT)", "mit", 1.0),
    ('content="SPDX-License-Identifier: MIT"/>', "mit", 1.0), ("SPDX-License-Identifier: MIT # all rights reserved", "mit,reserved", 1.0),
    ("SPDX-License-Identifier: -- none", "", 0.5), ("SPDX-License-Identifier: MIT OR", "", 0.5), ("SPDX-License-Identifier: (MIT", "", 0.5)])
def test_tags_in_comments_and_prose(line, labels, score):
    assert licenses.examine(line.encode(), licenses.finder())[5:] == (labels, score)


@pytest.mark.parametrize("text, labels, score", [
    ("GNU Lesser General Public License version 2.1", "gpl,lgpl-2.1-only", 0.6),
    ("GNU General Public License version 2 or any later version", "gpl,gpl-2.0-or-later", 0.4),
    ("under the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
     "option) any later version.", "gpl,gpl-2.0-or-later", 0.4),
    ("version 3 of the GNU General Public License", "gpl,gpl-3.0-only", 0.4),
    ("Eclipse Public License v1.0", "epl-1.0", 0.7), ("Eclipse Public License - v 2.0", "epl-2.0", 0.7),
    ("the Eclipse Public License", "epl", 0.7), ("General Public License v3", "gpl,gpl-3.0-only", 0.4),
    ("General Public License", "gpl", 0.4), ("GPLv3 or later", "gpl-3.0-or-later", 0.4), ("LGPLv2.1", "lgpl-2.1-only", 0.6),
    ("the GPL is long", "", 0.5), ("GPL 2", "gpl-2.0-only", 0.4), ("GNU Affero General Public License, version 3", "agpl-3.0-only,gpl", 0.3),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit", 1.0),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc", 1.0),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd-2-clause", 1.0),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided ... Neither the name of the "
     "owner", "bsd-3-clause", 1.0),
    ("This is free and unencumbered software released into the public domain.", "public-domain,unlicense", 1.0),
    ("in the public domain in some countries. All rights reserved.", "public-domain,reserved", 0.0),
    ("it is not in the public domain", "", 0.5), ("We placed this in the public domain", "public-domain", 0.5),
    ("hereby dedicated to the public domain", "public-domain", 1.0),
    ("the MIT License or the Apache License, Version 2.0", "apache-2.0,mit", 1.0),
    ("the MIT License and the GNU GPL version 3", "gpl-3.0-only,mit", 0.4),
    ("Creative Commons Attribution-ShareAlike 4.0 International", "cc-by-sa-4.0", 0.6), ("CC BY 4.0", "cc-by,cc-by-4.0", 0.9),
    ("CC BY-NC-ND 3.0", "cc-by,cc-by-nc-nd-3.0", 0.2), ("CC BY", "cc-by", 0.9), ("Mozilla Public License, v. 2.0", "mpl-2.0", 0.7),
    ("Apache Software License", "apache", 1.0), ("BSD 3-Clause License", "bsd-3-clause", 1.0)])
def test_notices(text, labels, score):
    assert licenses.examine(text.encode(), licenses.finder())[5:] == (labels, score)


def test_long_texts_and_clashing_columns(spark):
    long = ("GNU General Public License version 2 or later " * 30_000) + "word " * 200_000
    df = spark.createDataFrame([(1, long, "a", 3)], "doc_id bigint, text string, labels string, k int")
    row = licenses.scan(df).first()
    assert (row.n_base, row.labels, row.n_words) == (30_000, "gpl,gpl-2.0-or-later", 30_000 * 8 + 200_000)
