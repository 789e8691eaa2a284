"""Operators on single texts: licences, personal data, languages, packing, span removal."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tripwell.llm import language, license_scan, packing, pii, queries, substrings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 300_000
CLASHING = "doc_id long, text string, spans string, part int, fp string, keep int, `row` string, copies string, size string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, very long and repeated rows, and columns whose names operators use inside."""
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "Same text."), (5, "Same text."), (None, "Same text."), (6, "é" * 50)]
    return spark.createDataFrame([(i, t, "s", 1, "f", 1, "r", "c", "z") for i, t in rows], CLASHING)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# ---------------------------------------------------------------- licences

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""


def test_licenses_by_sentence_and_in_order(spark, odd, empty):
    pieces = MIT.split("\n\n")
    cases = {
        1: (MIT, ["MIT"]),
        2: ("\n\n".join(reversed(pieces)), []),
        3: ("text without a stop\nLicensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
        4: ("x.\nReleased under the MIT License. Licensed under CC BY-NC 4.0", ["MIT", "CC-BY-NC-4.0"]),
        5: ("unlicensed under the apache license version 2 0", []),
    }
    df = spark.createDataFrame([(i, t) for i, (t, _) in cases.items()], "doc_id long, text string")
    assert {r.doc_id: r.licenses for r in license_scan.scan_licenses(df).collect()} == {i: x for i, (_, x) in cases.items()}
    assert all(r.licenses == [] for r in license_scan.scan_licenses(odd).collect())
    assert rows_of(license_scan.scan_licenses(empty)) == []


GPL = """    This program is free software{} you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation{} either version {} of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */
"""
APACHE = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_NAME = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
LGPL = """    This library is free software; you can redistribute it and/or
    modify it under the terms of the GNU Lesser General Public
    License as published by the Free Software Foundation; either
    version 2.1 of the License, or (at your option) any later version.

    This library is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""


def test_licenses_in_their_real_wording(spark):
    tags = {"Apache-2.0": "Apache-2.0", "MIT": "MIT", "GPL-3.0-only": "GPL-3.0", "GPL-3.0-or-later": "GPL-3.0",
            "GPL-2.0-only": "GPL-2.0", "BSD-2-Clause": "BSD-2-Clause", "BSD-3-Clause": "BSD-3-Clause"}
    cases = [(f"{before}SPDX-License-Identifier: {tag}{after}", [name]) for tag, name in tags.items()
             for before, after in (("", ""), ("#!/bin/sh\n# ", "\nset -e\n"), ("/* ", " */\nint x;"))]
    cases += [(GPL.format(":", ",", 3), ["GPL-3.0"]), (GPL.format(";", ";", 2), ["GPL-2.0"]), (MPL, ["MPL-2.0"]),
              (GPL.format(";", ";", 3), ["GPL-3.0"]), (GPL.format(":", ",", 2), ["GPL-2.0"]),
              (APACHE, ["Apache-2.0"]), (BSD, ["BSD-2-Clause"]), (BSD + BSD_NAME, ["BSD-3-Clause"]), (BSD + BSD + BSD_NAME, ["BSD-2-Clause", "BSD-3-Clause"]),
              (BSD + MIT.split("\n\n")[1] + "\n" + BSD_NAME, ["BSD-3-Clause"]),
              (ISC, ["ISC"]), (MIT, ["MIT"]), ("The MIT License (MIT)\n", ["MIT"]),
              ("This is free and unencumbered software released into the public domain.\n", ["Unlicense"]),
              ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0"]), ("Licensed under CC BY 4.0.", ["CC-BY-4.0"]),
              ("Licensed under CC0 1.0.", ["CC0-1.0"]),
              *[(f"This work is licensed under a Creative Commons Attribution{k} 4.0 International License.", [name])
                for k, name in (("", "CC-BY-4.0"), ("-NonCommercial", "CC-BY-NC-4.0"), ("-ShareAlike", "CC-BY-SA-4.0"))],
              ("SPDX-License-Identifier: other. MIT", []), ("MIT. SPDX-License-Identifier:", []), ("? <0><1> |16|", []),
              ("This program is free software. Nothing else. You can go.", [])]
    cases += [(f"// SPDX-License-Identifier: {tag}\n", [name]) for tag, name in license_scan.TAGS.values()]
    cases += [(LGPL, ["LGPL-2.1"]), (GPL.format(":", ",", 3).replace("GNU General", "GNU Affero General"), ["AGPL-3.0"]),
              (GPL.format(";", ";", 3).replace("GNU General", "GNU Lesser General"), ["LGPL-3.0"]), (ZLIB, ["Zlib"]),
              (ISC.split(", provided")[0] + ".", ["0BSD"])]
    cases += [("\n".join(license_scan.WORDINGS[i][0] for i in (k,)), [name]) for k, name in
              ((64, "EPL-2.0"), (65, "BSL-1.0"), (66, "BSL-1.0"), (69, "Apache-2.0"), (70, "0BSD"))]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    rows = license_scan.scan_licenses(df).collect()
    got = {r.doc_id: r.licenses for r in rows}
    assert [got[i] for i in range(len(cases))] == [x for _, x in cases]
    con = duckdb.connect()
    documents = pa.table({"doc_id": list(range(len(cases))), "text": [t for t, _ in cases]})
    con.register("documents", documents)
    said = {r[0]: r[1:] for r in con.execute(license_scan.oracle()).fetchall()}
    assert said == {r.doc_id: (r.line_ids, r.wrapped_ids, ",".join(r.licenses)) for r in rows}


def test_license_plan_runs_no_python(spark, small):
    plan = queries.op10_license_scan(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# ---------------------------------------------------------------- personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain_spans(text):
    def valid(kind, s):
        digits = re.sub("[^0-9]", "", s)
        return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in s.split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m.group())]


def test_anchor_expansion_equals_plain_search():
    rng = random.Random(1)
    parts = ["@", ".", "1", "25", "a", "b-", "+", "+1", " ", "-", "4111111111111111", "4111 1111 1111 1111", "(", "x@y.z",
             "0", ":", "1.2.3.4", "é", "256"]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [s for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS] == plain_spans(text), text


def test_further_kinds_and_redaction():
    text = "iban: DE89 3704 0044 0532 0130 00, https://bob:pw@host.com/x, joe [at] foo [dot] com, token = \"a1b2c3d4e5f6a7\""
    assert {s[0] for s in pii.find_spans(text)} == {"account", "email", "masked_email", "secret", "url"}
    assert pii.redact("mail a@b.cd now") == "mail <EMAIL> now"
    assert pii.redact("a clean text, 12 apples") == "a clean text, 12 apples"
    assert pii.redact(None) is None


def test_ibans_anywhere_and_upper_case_masks():
    for iban in ("DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"):
        for before, after in (("pay to ", " now"), ("IBAN is ", ", thanks"), ("iban: ", ""), ("", " AND MORE 12"), ("(", ")")):
            text = before + iban + after
            assert ("account", len(before), len(before) + len(iban)) in pii.find_spans(text), text
    for text in ("pay to DE88 3704 0044 0532 0130 00 now", "XDE89370400440532013000"):
        assert "account" not in [s[0] for s in pii.find_spans(text)]
    for mask in ("joe [AT] foo [DOT] com", "joe (AT) foo (dot) com", "joe (At) foo (Dot) com"):
        assert pii.redact(f"write {mask} soon") == "write <MASKED_EMAIL> soon"


@pytest.mark.parametrize("part", ["http://a.b/x,", "://", "http://u:p@h/,", "@", "a@b", "[at]", "7", "1.2", "+4 ", "key=", "iban ", "x" * 50])
def test_long_texts_take_time_by_their_length(part):
    import time

    text = part * (2_000_000 // len(part))
    began = time.process_time()
    pii.find_spans(text)
    assert time.process_time() - began < 10


def test_links_in_one_run_equal_links_apart():
    text = "see ftp://a:b@c/d,https://x.y/z and ://q@ http://plain http://u@v://w"
    assert [text[a:b] for k, a, b in pii.find_spans(text) if k == "url"] == [
        "ftp://a:b@c/d,https://x.y/z", "http://u@v://w"]


def test_long_secrets_go_whole():
    for n in (511, 512, 513, 800, 20_000):
        value = ("Ab3-_" * n)[:n]
        text = f"token={value}, more"
        assert pii.find_spans(text) == [("secret", 6, 6 + n)]
        assert pii.redact(text) == "token=<SECRET>, more"


def test_scan_rows(spark, odd, empty):
    got = pii.scan_personal_data(odd)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert {r.base_sha256 for r in got.collect()} == {hashlib.sha256(b"").hexdigest()} and got.count() == 8
    assert rows_of(pii.scan_personal_data(empty)) == []
    assert sorted(rows_of(pii.redact_documents(odd)), key=str) == sorted(rows_of(odd), key=str)
    one = spark.createDataFrame([(1, "x a@b.cd", "en", "s", 8)], SCHEMA)
    assert rows_of(pii.redact_documents(one)) == [(1, "x <EMAIL>", "en", "s", 9)]


# ---------------------------------------------------------------- languages

def small_network(rng, hidden=3):
    net = language.Network.fresh(["a", "b", "c"], hidden, 1)
    for p in net.parts():
        p[...] = rng.standard_normal(p.shape) * 0.5
    return net


def test_gradient_through_time():
    rng = np.random.default_rng(0)
    net, data, labels = small_network(rng), rng.integers(0, 256, (5, 6)).astype(np.uint8), rng.integers(0, 3, 6)
    _, grads = language._gradients(net, data, labels)
    for p, g in zip(net.parts(), grads):
        at, step = np.unravel_index(np.abs(g).argmax(), p.shape), 1e-2
        was = p[at]
        p[at] = was + step
        up = language._gradients(net, data, labels)[0]
        p[at] = was - step
        down = language._gradients(net, data, labels)[0]
        p[at] = was
        assert abs((up - down) / 2 / step - g[at]) < 2e-3


def test_every_byte_counts_once_and_batches_do_not_matter():
    net = small_network(np.random.default_rng(2))
    texts = ["ab", "x" * 64, "hello wörld " * 20, "z"]
    together, marks = language.predict(net, texts, labels=True)
    alone = np.concatenate([language.predict(net, [t])[0] for t in texts])
    assert np.allclose(together, alone, atol=1e-6) and np.allclose(together.sum(axis=1), 1, atol=1e-5)
    assert [len(m) for m in marks] == [len(t.encode()) for t in texts]


def test_held_out_accuracy(spark):
    got = queries.op9_language(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) > 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark, odd, empty):
    from pyspark.sql import functions as F

    net = small_network(np.random.default_rng(3))
    got = language.identify(odd, net).collect()
    assert sum(r.lang_pred == "und" for r in got) == 3 and all(r.score == 0 for r in got if r.lang_pred == "und")
    assert all(r.spans[-1].end == len(r_text) for r in got for r_text in [LONG] if r.doc_id == 4)
    assert rows_of(language.identify(empty, net)) == []
    nothing = language.learn(empty, F.lit(True))
    assert {r.lang_pred for r in language.identify(odd, nothing).collect()} == {"und"}


# ---------------------------------------------------------------- packing

def test_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    path = queries.vocabulary()
    plain, ours = Tokenizer.from_file(path), packing.WordTokenizer(path)
    rng, parts = random.Random(2), list("ab'st!.,1 2\x1c\n\t\x00\x85\xa0éÉßµªşΣİ́日Kﬁ½<|>") + ["<|endoftext|>", "'s", "'ll", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in ours.encode(texts)] == want


def test_hilbert_curve_visits_neighbours():
    points = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = packing.hilbert_index(points, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def check_pieces(docs, pieces, length=2048):
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r.offset)
        fill = 0
        for r in rows:
            assert r.offset == fill
            fill += r.length
        assert fill == length or fill & (fill - 1) == 0
        assert fill <= length
    return by_doc


def test_pieces_round_trip(spark, small):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{small}/documents.parquet")
    by_doc = check_pieces(docs, packing.pack(docs, queries.vocabulary()).collect())
    plain = Tokenizer.from_file(queries.vocabulary())
    for d in docs.collect():
        ids = plain.encode(d.text, add_special_tokens=False).ids + [1]
        rows = sorted(by_doc[d.doc_id], key=lambda r: r.start)
        assert [i for r in rows for i in r.ids] == ids and all(r.doc_tokens == len(ids) for r in rows)
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)


def test_packing_odd_rows(odd, empty):
    rows = packing.pack(odd, queries.vocabulary(), with_ids=False).collect()
    by_doc = check_pieces(odd, rows)
    assert sum(r.length for r in by_doc[1]) == 1 and sum(r.length for r in by_doc[4]) == 300_001
    assert len({(r.sequence_id, r.offset) for r in by_doc[5]}) >= 2 and None in by_doc
    assert packing.pack(empty, queries.vocabulary()).collect() == []


# ---------------------------------------------------------------- span removal

def plain_removal(rows, span):
    words, first = [(i, (t or "").encode().split()) for i, t in rows], {}
    for i, w in words:
        for s in range(len(w) - span + 1):
            key = tuple(w[s:s + span])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, w in words:
        gone = {p for s in range(len(w) - span + 1) if first[tuple(w[s:s + span])] < i for p in range(s, s + span)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("span,gram,shard", [(6, 3, 5), (20, 8, 2000)])
def test_removal_equals_plain_windows(spark, span, gram, shard):
    rng, alphabet = random.Random(3), ["a", "b", "c", "d", "eé", "f"]
    base = [[rng.choice(alphabet) for _ in range(200)] for _ in range(4)]
    rows = []
    for _ in range(120):
        words = []
        for _ in range(rng.randint(0, 5)):
            s, b = rng.randint(0, 180), rng.choice(base)
            words += b[s:s + rng.randint(1, 60)] if rng.random() < 0.5 else [rng.choice(alphabet) for _ in range(rng.randint(1, 30))]
            words += ["x"] * rng.randint(0, 30) * (rng.random() < 0.3)
        rows.append((rng.randint(0, 10 ** 6), "\n".join(words)))
    rows += [(5, None), (6, ""), (7, " ".join(base[0])), (8, " ".join(base[0])), (9, " ".join(base[0]) + " z")]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), span=span, gram=gram,
                                    shard_segments=shard, with_text=False)
    assert sorted(rows_of(got)) == plain_removal(rows, span)


def test_blocks_of_one_segment_each_are_compared(spark):
    rng = random.Random(11)
    rows = []
    for k in range(30):  # two segments an anchor, alike but for their tails
        shared = [f"s{k}x{i}" for i in range(12)]
        rows += [(2 * k, " ".join(shared + [f"a{k}x{rng.random()}"])), (2 * k + 1, " ".join(shared + [f"b{k}x{rng.random()}"]))]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), span=6, gram=3,
                                    shard_segments=1, with_text=False)
    assert sorted(rows_of(got)) == plain_removal(rows, 6)


def test_removal_on_sample_and_odd_rows(spark, small, odd, empty):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(rows_of(queries.op7_substrings(spark, small))) == plain_removal(docs, 50)
    got = {(r.doc_id, r.n_words, r.n_removed) for r in substrings.remove_repeats(odd).collect()}
    assert got == {(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 300_000, 0), (5, 2, 0), (None, 2, 0), (6, 1, 0)}
    assert rows_of(substrings.remove_repeats(empty)) == []
