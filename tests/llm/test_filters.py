"""Operators that remove or mark text, against plain Python on small, awkward inputs."""

from __future__ import annotations

import random

import pytest
from brute_llm import benchmark_hits, jaccard_components, kept_lines, kept_words, sha

from tablesync.llm import decontaminate, jaccard_join, mix, substring_dedup
from tablesync.llm.components import components
from tablesync.llm.license_scan import SENTENCES, scan_licenses
from tablesync.llm.line_dedup import dedup_lines

SCHEMA = "doc_id long, text string, id string, pieces int, row string"


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", k, "y") for k, (i, t) in enumerate(rows)], SCHEMA)


def awkward(seed: int, n: int, words: int = 40, vocabulary: int = 60) -> list[tuple]:
    """Texts that share lines and passages; copies, nulls, blanks, one long text, repeated rows."""
    rng = random.Random(seed)
    names = [f"w{k}" for k in range(vocabulary)] + ["Ünï", "A.b", "🙂", "X-1"]
    passages = [" ".join(rng.choices(names, k=rng.randint(4, 30))) for _ in range(8)]
    rows: list[tuple] = []
    for i in range(n):
        parts = [" ".join(rng.choices(names, k=rng.randint(0, words))) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages))
        rows.append((i, rng.choice(["\n", " ", "\t\n"]).join(parts)))
    rows += [(n + k, rows[k % n][1]) for k in range(n // 4)]
    changed = [t.split(" ") for _, t in rows[: n // 4]]
    for own in changed:
        own[rng.randrange(len(own))] = "changed"
    rows += [(2 * n + k, " ".join(own)) for k, own in enumerate(changed)]
    rows += [(3 * n, None), (3 * n + 1, ""), (3 * n + 2, " \t\n "), (3 * n + 3, "one"), (3 * n + 4, "one")]
    rows += [(3 * n + 5, "again and " * 400), (None, passages[0]), (None, passages[0]), rows[0]]
    rng.shuffle(rows)
    return rows


def bag(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("window", [3, 6])
def test_repeated_passages(spark, window):
    rows = awkward(window, 40)
    got = substring_dedup.remove_repeats(frame(spark, rows), window=window)
    got = [(r["id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got.collect()]
    assert bag(got) == bag(kept_words(rows, window))


def test_divided_buckets(spark, monkeypatch):
    """Buckets that are divided where they arrive, and documents in many groups, give the same rows."""
    monkeypatch.setattr(substring_dedup, "BUCKET", 1)
    monkeypatch.setattr(substring_dedup, "DEALT", 1)
    monkeypatch.setattr(substring_dedup, "MET", 100)
    rows = awkward(4, 40)
    got = substring_dedup.remove_repeats(frame(spark, rows), window=4)
    got = [(r["id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got.collect()]
    assert bag(got) == bag(kept_words(rows, 4))


def test_windows_that_share_a_hash():
    """Equal first hashes don't make windows equal: the tag of the second hash parts them."""
    import numpy as np

    ids, pos = np.array([1, 2, 3, 4]), np.array([0, 0, 0, 0])
    hashes, tags = np.full(4, 7, np.uint64), np.array([5, 6, 5, 5], np.uint8)
    first, later = substring_dedup._first_of_each(ids, pos, hashes, tags)
    assert first.tolist() == [True, True, False, False] and later.tolist() == [False, False, True, True]


def test_the_second_hash_is_one_of_its_own():
    import numpy as np

    values = np.arange(1, 400, dtype=np.uint64)
    one = substring_dedup.window_hashes(values, 5)
    two = substring_dedup.window_hashes(values, 5, substring_dedup._OTHER)
    assert len(set(one.tolist())) == len(set(two.tolist())) == 395 and not set(one.tolist()) & set(two.tolist())
    again = substring_dedup.window_hashes(np.tile(values[:7], 3), 5, substring_dedup._OTHER)
    assert again[:7].tolist() == again[7:14].tolist()


def test_removed_ranges_are_maximal(spark):
    rows = [(1, "a b c d e f"), (2, "x a b c d y a b c z")]
    got = {r["id"]: r for r in substring_dedup.remove_repeats(frame(spark, rows), window=3).collect()}
    assert [tuple(r) for r in got[2]["removed"]] == [(1, 5), (6, 9)]
    assert got[2]["kept_text"] == "x y z" and got[1]["removed"] == []


def test_blocks_survive_packing():
    import numpy as np

    ids = np.array([3, 3, 3, 9, 9, 70])
    pos = np.array([0, 254, 70000, 5, 260, 300])
    hashes = np.arange(6, dtype=np.uint64)
    a, b, c = substring_dedup._unpack(substring_dedup._pack(ids, pos, hashes))
    assert (a == ids).all() and (b == pos).all() and (c == hashes).all()


@pytest.mark.parametrize("min_docs", [2, 3])
def test_shared_lines(spark, min_docs):
    rows = awkward(7, 40, words=4)
    got = dedup_lines(frame(spark, rows), min_docs=min_docs, min_chars=5)
    got = [(r["row"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got.collect()]
    assert bag(got) == bag(kept_lines(rows, min_docs, 5))


@pytest.mark.parametrize("row_cost", [4.0, 0.0])
@pytest.mark.parametrize("threshold", [(9, 10), (7, 10)])
def test_jaccard_components(spark, threshold, row_cost):
    rows = [(i, t) for i, t in dict(awkward(11, 60)).items() if i is not None]
    rows += [(1000 + k, " ".join(f"v{j}" for j in range(30) if j != k)) for k in range(30)]
    found = jaccard_join.jaccard_components(
        frame(spark, [*rows, (None, "one")]), ngram=2, threshold=threshold, row_cost=row_cost
    )
    got = {r["id"]: (r["n_grams"], r["component"]) for r in found.collect()}
    assert got.pop(None) == (1, None)
    assert got == jaccard_components(dict(rows), 2, *threshold)


def test_jaccard_of_nothing(spark):
    assert jaccard_join.jaccard_components(frame(spark, [])).collect() == []


def test_linked_sets_share_an_entry():
    """The pigeonhole: sets at the bound agree on a segment, in the band of the smaller one."""
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(200):
        size = int(rng.integers(9, 400))
        both = rng.integers(0, 1 << 62, size * 2).astype(np.uint64)
        small = np.unique(both[:size])
        apart = (2 * len(small)) // 19
        large = np.unique(np.concatenate([small[apart // 2 :], both[size : size + apart - apart // 2]]))
        small, large = sorted((small, large), key=len)
        common = len(np.intersect1d(small, large))
        if 100 * common < 90 * (len(small) + len(large) - common):
            continue
        band = jaccard_join._band_of(len(small), 9, 10)
        assert jaccard_join._band_of(len(large), 9, 10) in (band, band + 1)
        one, two = (jaccard_join.entries(g, band, 9, 10) for g in (small, large))
        assert ((one == two) & (one != 0)).any()


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {i: find(i) for a, b in links if a != b for i in (a, b)}


@pytest.mark.parametrize("max_bytes", [1 << 20, 40])
def test_benchmark_passages(spark, max_bytes):
    rows = awkward(13, 30)
    items = {1: rows[0][1] or "w1 w2", 22: "w1 w2 W3", 3: "ünï", 4: "", 5: None, 6: rows[3][1], 7: "w1 w2 w3"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontaminate.find_benchmark(
        frame(spark, rows), bench, window=4, max_automaton_bytes=max_bytes
    ).collect()
    got = [(r["row"]["doc_id"], r["row"]["text"], r["n_words"], r["n_hit"], r["items"]) for r in found]
    assert bag(got) == bag([(i, t, *benchmark_hits(t, items, 4)) for i, t in rows])
    assert all(r["contaminated"] == (r["n_hit"] > 0 and 20 * r["n_hit"] >= r["n_words"]) for r in found)
    for r in found:
        words = sum(len(decontaminate.words(r["row"]["text"][s["start"] : s["end"]].encode())) for s in r["spans"])
        assert words == r["n_hit"]


def test_empty_benchmark(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.find_benchmark(frame(spark, [(1, "a b")]), bench).collect()
    assert [(r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found] == [(2, 0, [], False)]


def test_large_benchmark_comes_in_bounded_parts(spark):
    """The bound holds for what the automaton is built from, windows, and not for the text of the items."""
    items = [(str(i), " ".join(f"w{i}x{k}" for k in range(60))) for i in range(30)]
    items += [("copy", items[0][1])]
    bench = spark.createDataFrame(items, "item string, text string")
    bound = 20_000
    sizes, seen = [], {}
    for part in decontaminate._patterns(bench, 13, bound):
        sizes.append(sum(len(w) for w, _ in part))
        assert not seen.keys() & {w for w, _ in part}
        seen |= dict(part)
    assert sum(len(t) for _, t in items) < bound < max(sum(sizes) / 5, bound + 1) and max(sizes) < 1.5 * bound
    assert seen.keys() == {w.decode() for _, t in items for w in decontaminate.windows(t.encode(), 13)}
    assert seen[decontaminate.windows(items[0][1].encode(), 13)[0].decode()] == ("0", "copy")


def test_licences(spark):
    mit = "Released under the MIT License. Enjoy.\nSee the GNU General Public License for more details."
    rows = [(1, mit), (2, None), (3, ""), (4, "This work is licensed under the GNU General Public License, version 3."),
            (5, "\n".join(s.upper() for s in SENTENCES)), (6, "released under the mit"), (6, mit), (None, mit)]
    got = scan_licenses(frame(spark, rows)).collect()
    by_id = [(r["row"]["doc_id"], r["n_sentences"], r["licenses"]) for r in got]
    assert by_id[:4] == [(1, 3, ["MIT"]), (2, 0, []), (3, 0, []), (4, 1, ["GPL-3.0"])]
    assert by_id[5:] == [(6, 1, []), (6, 3, ["MIT"]), (None, 3, ["MIT"])]
    assert {"Apache-2.0", "MIT", "BSD-3-Clause", "ISC", "MPL-2.0", "CC-BY-4.0"} <= set(by_id[4][2])
    assert got[0]["sentence_ids"] == ["MitRef", "GnuSee"]


PUBLISHED = {
    "GPL-3.0-or-later": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
""",
    "GPL-2.0-or-later": """/*
 * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
 */
""",
    "MPL-2.0": """dnl This Source Code Form is subject to the terms of the Mozilla Public
dnl License, v. 2.0. If a copy of the MPL was not distributed with this
dnl file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
""",
    "BSD-3-Clause": """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
#
# 1) Redistributions of source code must retain the above copyright notice, this
#    list of conditions and the following disclaimer.
# 2. Redistributions in binary form must reproduce the above copyright notice,
#    this list of conditions and the following disclaimer in the documentation
#    and/or other materials provided with the distribution.
# 3. Neither the name of the copyright holder nor the names of its
#    contributors may be used to endorse or promote products derived from
#    this software without specific prior written permission.
""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
""",
    "Apache-2.0": """// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
// Unless required by applicable law or agreed to in writing, software
// distributed under the License is distributed on an "AS IS" BASIS,
// WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
""",
}


def test_published_licences(spark):
    """As they are published: wrapped, with colons, semicolons, abbreviations and comment marks."""
    rows = list(enumerate(PUBLISHED.values()))
    got = {r["row"]["doc_id"]: r for r in scan_licenses(frame(spark, rows)).collect()}
    assert [got[i]["licenses"] for i, _ in rows] == [[name] for name in PUBLISHED]
    assert got[0]["sentence_ids"] == ["Gpl3PlusGrant", "GnuHope", "GnuSee"]
    assert got[6]["sentence_ids"] == ["Apache2Ref", "ApacheCompliance", "ApacheAsIs"]


def test_mixed_shares(spark):
    rows = [(i, f"t{i}", "big" if i % 10 else "small") for i in range(4000)] + [(None, None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rates = mix.source_rates(docs, weights={"big": 1.0, "small": 3.0})
    out = mix.mix(docs, rates).collect()
    shares = {s: sum(r["row"]["source"] == s for r in out) / len(out) for s in ("big", "small")}
    assert abs(shares["small"] - 0.75) < 0.03 and abs(len(out) / 4003 - 1) < 0.06
    assert len({(r["row"]["doc_id"], r["copy"]) for r in out}) == len(out)
    again = mix.mix(docs.repartition(7), rates).collect()
    assert bag([(r["row"]["doc_id"], r["copy"]) for r in again]) == bag([(r["row"]["doc_id"], r["copy"]) for r in out])


def test_large_rates_keep_their_mean(spark):
    docs = spark.createDataFrame([(i, "t", "s") for i in range(20)], "doc_id long, text string, source string")
    rates = spark.createDataFrame([("s", 20, 1300.0)], "source string, n_docs long, rate double")
    assert abs(mix.mix(docs, rates).count() / 20 - 1300) < 60


def test_missing_source_is_a_source(spark):
    docs = spark.createDataFrame([(i, "t", None) for i in range(300)], "doc_id long, text string, source string")
    assert 200 < mix.mix(docs, mix.source_rates(docs)).count() < 400
    empty = docs.limit(0)
    assert mix.mix(empty, mix.source_rates(empty)).count() == 0
    assert sha("") == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_line_ends_that_are_no_white_space(spark):
    """U+0085, U+2028 and U+2029 end no line here, and blanks before them stay."""
    rows = []
    for k, odd in enumerate(["\x85", "\u2028", "\u2029", "\r"]):
        rows += [(10 * k, f"hello there again{odd}"), (10 * k + 1, f"hello there again {odd}"), (10 * k + 2, f"hello there again{odd} ")]
    got = sorted((r["row"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in dedup_lines(frame(spark, rows)).collect())
    assert got == sorted(kept_lines(rows, 2, 10))


def test_rows_without_id_draw_on_their_own(spark):
    docs = spark.range(800).selectExpr("IF(id < 400, NULL, id) AS doc_id", "'same' AS text", "'s' AS source")
    rates = spark.createDataFrame([("s", 1.0)], "source string, rate double")
    kept = mix.mix(docs, rates).groupBy("row").count().where("row.doc_id IS NULL").first()["count"]
    assert 300 < kept < 500


def test_near_copies_of_a_chain_give_few_links(spark):
    """Blocks unite components; they never give all pairs of a group."""
    rng = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    rows, own = [], rng.choices(words, k=120)
    for i in range(160):
        own = [*own]
        own[rng.randrange(len(own))] = rng.choice(words)
        rows.append((i, " ".join(own)))
    got = jaccard_join.jaccard_components(frame(spark, rows), ngram=3, threshold=(9, 10)).collect()
    assert {r["id"]: (r["n_grams"], r["component"]) for r in got} == jaccard_components(dict(rows), 3, 9, 10)
