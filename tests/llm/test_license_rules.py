import itertools
import re
from re import _parser

from quern.llm.license_rules import BASE_PHRASES, _gate, scan_licenses, signature_rules

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = W.findall(low)
    found = []
    for phrase, label in BASE_PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    at = [i for i, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), sorted({x for _, x in found})


def test_base_is_that_of_plain_loops(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = scan_licenses(documents, ["doc_id"]).collect()
    assert len(rows) == len(texts)
    hits = 0
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id]), r.doc_id
        assert set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1
        low = (texts[r.doc_id] or "").lower()
        for d in r.detections:
            rule = [x for x in signature_rules() if x.label == d.label and re.fullmatch(x.pattern, low[d.start : d.end])]
            assert rule
        hits += r.n_base
    assert hits


def test_rules_are_in_order_and_pass_their_own_gate():
    rules = signature_rules()
    assert len(rules) >= 300 and [r.priority for r in rules] == list(range(len(rules)))
    for r in rules:
        re.compile(r.pattern)


def test_every_rule_finds_a_notice(spark):
    """A notice is made from each licence's name or identifier; the gate and keyword let it through."""
    samples = [
        ("Released under the terms of the GNU Lesser General Public License, version 2.1", "lgpl"),
        ("SPDX-License-Identifier: MPL-2.0", "mpl"),
        ("see https://creativecommons.org/licenses/by-nc/4.0/", "cc-by-nc"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("BSD 3-Clause", "bsd-3-clause"),
        ("This is free and unencumbered; see unlicense.org", "unlicense"),
        ("All rights reserved", "proprietary"),
        ("dedicated under CC0 1.0 Universal", "cc0"),
        ("Open Data Commons Open Database", "odbl"),
    ]
    df = spark.createDataFrame(list(enumerate(t for t, _ in samples)), "doc_id long, text string")
    got = {r.doc_id: r for r in scan_licenses(df, ["doc_id"]).collect()}
    for i, (text, label) in enumerate(samples):
        assert re.search(_gate(signature_rules()), text.lower()), text
        assert label in got[i].labels, (text, got[i])


def test_containment_and_priority(spark):
    df = spark.createDataFrame([(0, "Licensed under the Apache License, Version 2.0. cc-by-nc-sa 4.0")], "doc_id long, text string")
    row = scan_licenses(df, ["doc_id"]).first()
    assert [(d.label, d.start) for d in row.detections] == [("apache", 0), ("cc-by-nc-sa", 48)]


def test_hard_rows(hard, nothing):
    rows = scan_licenses(hard, ["doc_id"]).collect()
    assert len(rows) == hard.count()
    assert all(r.labels is not None and r.score is not None for r in rows)
    assert scan_licenses(nothing, ["doc_id"]).collect() == []


def matches_of(items):
    """Texts that a parsed pattern matches: each alternative, with and without what is optional."""
    out = [""]
    for op, value in items:
        if op is _parser.LITERAL:
            some = [chr(value)]
        elif op is _parser.ANY:
            some = ["x"]
        elif op is _parser.IN:
            some = [" "] if value[0][0] is _parser.NEGATE else [chr(v[0] if o is _parser.RANGE else v) if o is not _parser.CATEGORY else "a" for o, v in value[:4]]
        elif op is _parser.BRANCH:
            some = [x for branch in value[1] for x in matches_of(branch)]
        elif op is _parser.SUBPATTERN:
            some = matches_of(value[-1])
        elif op is _parser.MAX_REPEAT:
            least, most, body = value
            some = [x * n for n in dict.fromkeys((least, min(least + 1, most))) for x in matches_of(body)]
        elif op is _parser.ASSERT:
            some = matches_of(value[1])
        else:
            assert op is _parser.ASSERT_NOT
            some = [""]
        out = list(dict.fromkeys(a + b for a, b in itertools.product(out, some)))[:2000]
    return out


def test_gate_and_keyword_let_every_rule_through(spark):
    gate = re.compile(_gate(signature_rules()))
    rows = []
    for r in signature_rules():
        texts = matches_of(_parser.parse(r.pattern))
        assert all(re.search(r.pattern, t) and r.keyword in t and gate.search(t) for t in texts), r
        rows.append((r.priority, texts[0]))
    found = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()
    # The match itself is found whole, by this rule or by one that comes earlier or covers more.
    assert len(found) == len(rows)
    for r in found:
        text = rows[r.doc_id][1]
        assert min(d.start for d in r.detections) == 0 and max(d.end for d in r.detections) == len(text), text


def test_identifiers_without_the_name(spark):
    texts = {
        "AGPL-3.0": "agpl", "SPDX-License-Identifier: AGPL-3.0-only": "agpl", "LGPL-2.1": "lgpl", "GFDL-1.3": "gfdl", "BSL-1.0": "bsl",
        "BUSL-1.1": "busl", "SSPL-1.0": "sspl", "Common Public Attribution License": "cpal", "PHP-3.01": "php", "GPL-3.0-or-later": "gpl",
        "https://creativecommons.org/publicdomain/zero/1.0/": "cc0", "https://www.gnu.org/licenses/agpl.html": "agpl",
        "https://opensource.org/licenses/MS-PL": "ms-pl", "https://scripts.sil.org/OFL": "ofl", "into the public\ndomain": "public-domain",
    }
    df = spark.createDataFrame(list(texts.items()), "text string, label string")
    for r in scan_licenses(df, ["text", "label"]).collect():
        assert r.labels == [r.label], r


#: Notices as they stand in files and on pages, written without looking at the rules.
NOTICES = {
    "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: ISC": "isc", "SPDX-License-Identifier: EPL-2.0": "epl",
    "SPDX-License-Identifier: Zlib": "zlib", "SPDX-License-Identifier: Unlicense": "unlicense", "SPDX-License-Identifier: PostgreSQL": "postgresql",
    "SPDX-License-Identifier: OpenSSL": "openssl", "SPDX-License-Identifier: Ruby": "ruby", "SPDX-License-Identifier: AFL-3.0": "afl",
    "SPDX-License-Identifier: OSL-3.0": "osl", "SPDX-License-Identifier: MS-PL": "ms-pl", "SPDX-License-Identifier: CPL-1.0": "cpl",
    "SPDX-License-Identifier: LPPL-1.3c": "lppl", "SPDX-License-Identifier: Python-2.0": "psf", "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
    "# SPDX-License-Identifier: GPL-2.0+": "gpl", "// SPDX-License-Identifier: Apache-2.0": "apache",
    "This package is released under MIT.": "mit", "The code is licensed under the ISC terms": "isc", "under AGPLv3": "agpl", "LGPLv3 or newer": "lgpl",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": "mit",
    "Redistribution and use in source and binary forms, with or without\n * modification, are permitted": "bsd",
    "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted": "isc",
    "This is free and unencumbered software released into the public domain.": "public-domain,unlicense",
    "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License": "lgpl",
    "1. The origin of this software must not be misrepresented;": "zlib",
    "No rights reserved.": "cc0", "Apache-2.0 OR MIT": "apache,mit", "license = \"MIT OR Apache-2.0\"": "apache,mit",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl",
    "requires Python 2.0 or newer": "", "he studied at MIT or Harvard": "", "zlib and openssl are needed to build ruby": "", "Expat parses XML": "",
}


def test_real_notices(spark):
    df = spark.createDataFrame(list(NOTICES.items()), "text string, want string")
    got = {r.text: ",".join(r.labels) for r in scan_licenses(df, ["text", "want"]).collect()}
    assert {t: (got[t], w) for t, w in NOTICES.items() if got[t] != w} == {}
