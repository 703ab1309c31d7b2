"""Near-dedup, substring dedup, packing, licenses, pieces and languages against brute force, with edge cases."""

import bisect
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers_llm import BASE, LONG, TEXTS, brute_components, brute_repeats, documents, shingles
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mutated(rng, text, rate):
    return " ".join(f"m{rng.randrange(10**6)}" if rng.random() < rate else w for w in text.split())


@pytest.fixture(scope="module")
def crowd():
    """Groups of near copies around the threshold, chains of copies, shared passages."""
    rng, rows = random.Random(4), []
    for g in range(12):
        base = " ".join(f"g{g}v{rng.randrange(10**6)}" for _ in range(rng.choice([12, 40, 120])))
        last = base
        for _ in range(rng.choice([2, 5, 25])):
            rows.append(mutated(rng, base, rng.choice([0.0, 0.01, 0.02, 0.03, 0.05])))
            last = mutated(rng, last, 0.015)
            rows.append(last)
    passage = " ".join(f"p{i}" for i in range(55))
    rows += [f"{mutated(rng, BASE, 0.9)} {passage} {mutated(rng, BASE, 0.9)}" for _ in range(20)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}


# -- near-dedup ----------------------------------------------------------------------------------------


def test_near_duplicates(spark, crowd):
    from graphloom.llm.neardup import near_duplicates

    for rows in (TEXTS, crowd):
        df = near_duplicates(documents(spark, rows))
        assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"] and df.count() == len(rows)
        got = by_id(df)
        want = brute_components(rows)
        assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
        assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_near_duplicates_of_nothing(spark):
    from graphloom.llm.neardup import near_duplicates, one_of_each_group

    assert near_duplicates(documents(spark).limit(0)).count() == 0
    lost = near_duplicates(documents(spark)).filter("doc_id is null").collect()
    assert len(lost) == 2 and all(r["kept"] and r["component_id"] is None for r in lost)
    left = one_of_each_group(documents(spark))
    assert left.columns == documents(spark).columns
    keep = {i for i, (_, c) in brute_components(TEXTS).items() if i == c}
    assert {r["doc_id"] for r in left.collect()} == keep | {None}


def test_one_of_each_group_keeps_columns_of_any_name(spark):
    from graphloom.llm.neardup import one_of_each_group

    rows = [(i, t, n, f"{i}", n, n, n, n) for n, (i, t) in enumerate(TEXTS)]
    names = ["doc_id", "text", "_id", "_x", "a.b", "row", "id", "x"]
    docs = spark.createDataFrame(rows, T.StructType([T.StructField(n, T.StringType() if n in ("text", "_x") else T.LongType()) for n in names]))
    left = one_of_each_group(docs)
    assert left.columns == names
    got = sorted(r["a.b"] for r in left.collect())
    plain = one_of_each_group(docs.select("doc_id", "text", F.col("`a.b`").alias("n")))
    assert len(got) == plain.count() < len(rows)
    assert one_of_each_group(docs.limit(0)).count() == 0


def test_repair_finds_links_that_no_leader_has(spark):
    """Every link of alike documents is found from the shingle rows alone, whatever their components."""
    from graphloom.llm.neardup import _repair_pairs

    rng = random.Random(1)
    sets = [set(rng.sample(range(30), rng.randrange(8, 20))) for _ in range(60)]
    rows = [(h, i, i, len(s)) for i, s in enumerate(sets) for h in s]
    pairs = {(r["a"], r["b"]) for r in _repair_pairs(spark.createDataFrame(rows, "h long, node long, component long, n int"), 75).collect()}
    found = {tuple(sorted(p)) for p in pairs}
    want = {(a, b) for a in range(60) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert {tuple(sorted(p)) for p in want} <= found


def test_components_of_chains(spark):
    from graphloom.operators.components import components

    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(chain, "a", "b").collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}
    assert components(chain.limit(0), "a", "b").count() == 0


# -- substring dedup -----------------------------------------------------------------------------------


def test_repeats(spark, crowd):
    from graphloom.llm.substring import remove_repeats

    for rows in (TEXTS, crowd):
        df = remove_repeats(documents(spark, rows))
        assert df.count() == len(rows)
        assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in by_id(df).items()} == brute_repeats(rows)


def test_repeats_do_not_depend_on_how_a_later_scan_is_cut(spark, tmp_path):
    from graphloom.llm.substring import remove_repeats

    rows = [(2, "a " + BASE), (3, "b " + BASE), (1, "c " + BASE)]
    documents(spark, rows).coalesce(1).write.parquet(str(tmp_path / "d"))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for first, later in (2, 1), (1, 2), (3, 1):
            spark.conf.set(name, first)
            df = remove_repeats(spark.read.parquet(str(tmp_path / "d")))
            spark.conf.set(name, later)
            assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in by_id(df).items()} == brute_repeats(rows)
    finally:
        spark.conf.set(name, before)


def test_repeats_keep_rows_and_layout(spark):
    from graphloom.llm.substring import remove_repeats, without_repeats

    nulls = remove_repeats(documents(spark)).filter("doc_id is null").collect()
    assert sorted((r["n_words"], r["n_removed"]) for r in nulls) == [(0, 0), (60, 0)]
    out = without_repeats(documents(spark))
    assert out.schema.names == documents(spark).schema.names and out.count() == len(TEXTS)
    text = {r["doc_id"]: r["text"] for r in out.collect() if r["doc_id"] is not None}
    assert text[8] == "One  two\nTHREE" and text[10] == "zzz tail" and text[4] is None
    assert text[16] == "other rest" and text[12] == "extra words at the end"
    assert without_repeats(documents(spark).limit(0)).count() == 0


# -- packing -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("capacity", [4096, 50])
def test_packing(spark, capacity):
    from tokenizers import Tokenizer

    from graphloom.llm.packing import default_tokenizer, pack_documents

    out = pack_documents(documents(spark), capacity).toPandas()
    tok, want, total = Tokenizer.from_file(default_tokenizer()), [], 0
    for i, t in TEXTS:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        for p, lo in enumerate(range(0, len(ids), capacity)):
            part = ids[lo : lo + capacity]
            want.append((i, p, lo, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))))
    key = lambda r: tuple(-1 if x is None or x != x else int(x) for x in r)
    assert sorted(map(key, out[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False))) == sorted(map(key, want))
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g["length"].sum() <= capacity and list(g["offset"]) == [0, *g["length"].cumsum()[:-1]]
    assert pack_documents(documents(spark).limit(0)).count() == 0


def test_words_encode_as_their_text():
    from tokenizers import Tokenizer

    import numpy as np

    from graphloom.llm.packing import WordIds, default_tokenizer

    texts = ["it's (don't) x,y;z a-b", "a<|endoftext|>b, <|startoftext|>", "É éa, à. ﬁ\u0301", "12ab3 'LL \u00a0x\u2028y", "...!!", "İstanbul, ǅ ẞ", "日本,語"]
    ids, counts = WordIds(default_tokenizer()).of(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)]))
    tok = Tokenizer.from_file(default_tokenizer())
    assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def best_fit_decreasing(sizes, capacity):
    """The number of sequences, one document at a time."""
    bins = []
    for size in sorted(sizes, reverse=True):
        at = bisect.bisect_left(bins, size)
        gap = bins.pop(at) if at < len(bins) else capacity
        bisect.insort(bins, gap - size)
    return len(bins)


def rounds_of_sweeps(counts, capacity):
    """The rounds of packing_plan without Spark: (plan, number of sequences)."""
    from graphloom.llm.packing import DOCUMENTS, GAPS, LATER, PLACED, RANGES, sweep

    runs, plan, opened = [(DOCUMENTS, z, n, 0, 0, 0, 0, 0) for z, n in counts.items()], [], 0
    while any(r[0] == DOCUMENTS for r in runs):
        runs = [(GAPS if r[0] == LATER else r[0], *r[1:]) for r in runs]
        level = 0
        while 1 << level <= RANGES:
            groups = {}
            for r in runs:
                groups.setdefault((r[1] - 1) * RANGES // capacity >> level, []).append(r)
            runs = [r for g in groups.values() for r in sweep(g, capacity, opened if 1 << level == RANGES else None)]
            level += 1
        plan += [(r[1], r[3], *r[4:7], r[2]) for r in runs if r[0] == PLACED]
        opened += sum(r[7] for r in runs)
        runs = [r for r in runs if r[0] != PLACED]
    return plan, opened


def test_sweeps_place_every_document_once_and_pack_well():
    rng = random.Random(2)
    for trial in range(40):
        capacity = rng.choice([10, 37, 100, 4096])
        shape = rng.choice([lambda: rng.randrange(1, capacity), lambda: 1 + int((capacity - 2) * rng.random() ** 3), lambda: rng.choice([1, 2, capacity // 3, capacity // 2 + 1, capacity - 1])])
        sizes = [shape() for _ in range(rng.randrange(1, 4000))]
        counts = {z: sizes.count(z) for z in set(sizes)}
        plan, opened = rounds_of_sweeps(counts, capacity)
        filled, ranks = {}, {}
        for size, rank, first, each, offset, n in plan:
            ranks.setdefault(size, []).extend(range(rank, rank + n))
            for i in range(n):
                filled.setdefault(first + i // each, []).append((offset + i % each * size, size))
        assert all(sorted(ranks[z]) == list(range(n)) for z, n in counts.items())
        assert len(filled) == opened
        for places in filled.values():
            at = 0
            for offset, size in sorted(places):
                assert offset == at
                at += size
            assert at <= capacity
        best = best_fit_decreasing(sizes, capacity)
        assert opened <= best * 1.02 + 2, (trial, capacity, opened, best)


def test_packing_plan_is_made_of_these_rounds(spark):
    from graphloom.llm.packing import packing_plan

    rng = random.Random(3)
    counts = {z: rng.randrange(1, 50) for z in rng.sample(range(1, 500), 200)}
    plan, opened = packing_plan(spark.createDataFrame(list(counts.items()), "length long, count long"), 500)
    want, sequences = rounds_of_sweeps(counts, 500)
    assert opened == sequences and plan.tolist() == sorted(list(r[:5]) for r in want)
    assert packing_plan(spark.createDataFrame([], "length long, count long"), 10)[1] == 0


def test_packing_of_rows_without_ids(spark):
    """Many equal rows without an id: each gets its own place."""
    from graphloom.llm.packing import pack_documents

    out = pack_documents(documents(spark, [(None, "one two three")] * 500 + [(None, None)] * 500), 64).toPandas()
    assert len(out) == 1000 and not out.duplicated(["sequence_id", "offset"]).any()
    assert out.groupby("sequence_id")["length"].sum().max() <= 64


# -- licenses ------------------------------------------------------------------------------------------


def test_license_scan(spark):
    from graphloom.llm.licenses import BASE as PHRASES
    from graphloom.llm.licenses import rules, scan_licenses

    extra = [(50, "Licensed under the Apache License, Version 2.0. All rights reserved."), (51, "CC-BY 4.0, cc by; General Public License"), (52, "cc byline occ by"), (53, "all rights reserved " * 3)]
    rows = TEXTS + extra
    got = scan_licenses(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    import re

    for r, (i, t) in zip(sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)), sorted(rows, key=lambda x: (x[0] is None, x[0] or 0))):
        if i is None:
            continue
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        at = {j: label for p, label in PHRASES.items() for j in range(len(w)) if w[j : j + len(p.split())] == p.split()}
        assert r["n_words"] == len(w) and r["n_base"] == len(at)
        assert (r["first_word"], r["last_word"]) == ((min(at), max(at)) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted(set(at.values())))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1
    found = {r["doc_id"]: r["labels"] for r in got}
    assert found[50] == "apache-2.0,reserved" and "cc-by-4.0" in found[51] and found[52] == ""
    assert len(rules()) >= 200
    assert scan_licenses(documents(spark).limit(0)).count() == 0


def sample_phrases(tree):
    """Texts that a parsed pattern matches, with each alternative and each optional part in some."""
    out = [""]
    for op, value in tree:
        name = str(op)
        if name == "LITERAL":
            some = [chr(value)]
        elif name == "IN":
            some = sorted({chr(v if str(o) == "LITERAL" else v[0]) if str(o) != "CATEGORY" else "q" for o, v in value})
        elif name == "SUBPATTERN":
            some = sample_phrases(value[3])
        elif name == "BRANCH":
            some = [t for branch in value[1] for t in sample_phrases(branch)]
        elif name == "MAX_REPEAT":
            low, high, part = value
            parts = sample_phrases(part)
            some = sorted({t * n for t in parts for n in (low, min(high, low + 1))})
        else:
            assert name == "ASSERT"
            some = [""]
        out = [a + b for a in out for b in some]
    return out


def test_each_license_rule_fires_on_its_own_phrases():
    import re._parser

    from graphloom.llm.licenses import Scanner, rules

    scanner = Scanner()
    for rule in rules():
        for phrase in sample_phrases(re._parser.parse(rule.pattern.pattern)):
            assert any(word in phrase for word in rule.keywords), (rule, phrase)
    for text, label in [("provided as is without warranty of any kind", "warranty"), ("without warranties or conditions of any kind", "warranty"), ("PSF license", "python-2.0"), ("Internet Systems Consortium License", "isc"), ("released under the PNG Reference Library License", "libpng"), ("open data commons database license", "odbl-1.0")]:
        _, _, _, _, _, labels, score, spans = scanner.scan(text)
        assert label in labels.split(",") and score > 0 and spans, text


def test_suppression():
    from graphloom.llm.licenses import suppressed

    rng = random.Random(3)
    for _ in range(200):
        hits = [(rng.choice([1, 2, 3]), a := rng.randrange(20), a + rng.randrange(1, 8), rng.choice("xyz")) for _ in range(12)]
        kept = []
        for h in sorted(set(hits), key=lambda h: (-h[0], h[1] - h[2], h[1], h[3])):
            if not any(k[1] <= h[1] and h[2] <= k[2] for k in kept):
                kept.append(h)
        assert suppressed(hits) == sorted(kept, key=lambda h: (h[1], h[2], h[3]))


TAG_LABELS = {"MIT": "mit", "ISC": "isc", "EPL-2.0": "epl-2.0", "Unlicense": "unlicense", "Zlib": "zlib", "CDDL-1.0": "cddl-1.0", "PostgreSQL": "postgresql", "OFL-1.1": "ofl-1.1", "BSL-1.0": "bsl-1.0", "EUPL-1.2": "eupl-1.2", "LGPL-2.1-only": "lgpl-2.1", "GPL-3.0-or-later": "gpl-3.0", "MIT OR Apache-2.0": "apache-2.0,mit"}


def test_tags_are_labelled_by_their_ids():
    from graphloom.llm.licenses import Scanner

    scanner = Scanner()
    for tag, label in TAG_LABELS.items():
        for text in (f"// SPDX-License-Identifier: {tag}", f"/* SPDX-License-Identifier: {tag} */ int x;"):
            assert set(label.split(",")) <= set(scanner.scan(text)[5].split(",")), (tag, scanner.scan(text))


def test_long_texts_full_of_notices_take_time_in_proportion():
    import time

    from graphloom.llm.licenses import Scanner

    scanner, seconds = Scanner(), []
    for many in (20_000, 80_000):
        began = time.process_time()
        *_, spans = scanner.scan("copyright 2020 licensed under the mit license " * many)
        seconds.append(time.process_time() - began)
        assert spans[0][:2] == (0, 2) and spans[-1][1] == 7 * many
    assert seconds[1] < 8 * seconds[0]


# -- pieces --------------------------------------------------------------------------------------------


def test_pieces_without_dropout_are_the_models(spark):
    from sentencepiece import SentencePieceProcessor

    from graphloom.llm.pieces import default_model, encode_pieces

    model = SentencePieceProcessor(model_file=default_model())
    rows = [(i, t) for i, t in TEXTS if i not in (None, 12)] + [(60, "x" * 300), (61, " " * 70), (62, "  a   b ")]
    got = {r["doc_id"]: r["ids"] for r in encode_pieces(documents(spark, rows), 0.0).collect()}
    assert got == {i: model.encode(t or "") for i, t in rows}


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.9, 1.0])
def test_pieces_decode_losslessly(spark, rate):
    from graphloom.llm.pieces import decode_pieces, encode_pieces

    rows = [*TEXTS, (70, "▁x ▁ \u0000 \u2028"), (71, "y" * 500)]
    docs = documents(spark, rows)
    a = decode_pieces(encode_pieces(docs, rate)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in a) == sorted((i or 0, t or "") for i, t in rows)
    b = decode_pieces(encode_pieces(docs.repartition(3), rate)).collect()
    assert sorted((r["doc_id"] or 0, r["ids_crc32"]) for r in a) == sorted((r["doc_id"] or 0, r["ids_crc32"]) for r in b)
    assert encode_pieces(docs.limit(0)).count() == 0


def test_dropout_varies_and_both_agendas_agree(spark):
    import numpy as np

    from graphloom.llm import pieces as P

    v = P.Vocabulary(P.default_model())
    rng = random.Random(5)
    for _ in range(200):
        word = " " + "".join(rng.choice("theraionxyé") for _ in range(rng.randrange(1, 20)))
        ids = np.array([[v.ids.get("▁" if c == " " else c, -1) for c in word]])
        key = np.array([rng.getrandbits(64)], np.uint64)
        pieces, begins = P._matrix(v, ids, key, 0.2)
        assert pieces[0][begins[0]].tolist() == [p for p, _ in P._agenda(v, ids[0].tolist(), key[0], 0.2)]
    docs = documents(spark, [(i, "interesting information " * 20) for i in range(3)])
    runs = {s: [tuple(r["ids"]) for r in P.encode_pieces(docs, 0.3, s).orderBy("doc_id").collect()] for s in (1, 2)}
    assert runs[1] != runs[2] and len(set(runs[1])) > 1


def naive_pieces(text, doc_id, rate, seed, vocabulary, word_hash):
    """Merge-dropout by looking at all neighbours after each merge, with its own arithmetic of the keyed hash."""
    from graphloom.llm import pieces as P

    low, salts = (1 << 64) - 1, [int(x) for x in P._SALTS]

    def mixed(x):
        x &= low
        x = (x ^ x >> 33) * 0xFF51AFD7ED558CCD & low
        x = (x ^ x >> 33) * 0xC4CEB9FE1A85EC53 & low
        return x ^ x >> 33

    out, words = [], re.findall(r" +[^ ]*|[^ ]+", " " + text if text else "")
    for nth, word in enumerate(words):
        key = mixed(mixed(mixed(doc_id * salts[2]) + nth * salts[3] + seed * salts[4]) ^ word_hash(word))
        parts, merged, skips = [(i, c) for i, c in enumerate(word)], True, {}
        while merged:
            best = None
            for (p, a), (_, b) in zip(parts, parts[1:]):
                piece = vocabulary.ids.get((a + b).replace(" ", P.SPACE)) if P.SPACE not in a + b else None
                if piece is None or any(len(x) > 1 and x.replace(" ", P.SPACE) not in vocabulary.ids for x in (a, b)) or any(len(x) == 1 and x.replace(" ", P.SPACE) not in vocabulary.ids for x in (a, b)):
                    continue
                out_of = skips.setdefault((p, piece), mixed((key ^ p * salts[0] & low) + piece * salts[1]) >> 11 < int(rate * (1 << 53)))
                if not out_of and (best is None or (int(vocabulary.rank[piece]), p) < best):
                    best = (int(vocabulary.rank[piece]), p)
            merged = best is not None
            if merged:
                i = next(i for i, (p, _) in enumerate(parts) if p == best[1])
                parts[i : i + 2] = [(best[1], parts[i][1] + parts[i + 1][1])]
        for _, part in parts:
            found = vocabulary.ids.get(part.replace(" ", P.SPACE)) if P.SPACE not in part else None
            out += [found] if found is not None else [int(x) for x in vocabulary.byte[list(part.encode())]]
    return out


def test_dropout_is_that_of_a_naive_agenda(spark):
    import numpy as np

    from graphloom.llm import pieces as P

    vocabulary = P.Vocabulary(P.default_model())
    hashed = lambda w: int(P.span_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w.encode())]), 61)[0])
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["information", "the", "house", "unbelievable", "x9 ", "\u65e5\u672c", "\u2581a", "re-" + "do" * 30]) for _ in range(40))) for i in range(5)] + [(9, None), (-4, "a  b")]
    for rate in (0.1, 0.4):
        got = {r["doc_id"]: r["ids"] for r in P.encode_pieces(documents(spark, rows), rate, 11).collect()}
        assert got == {i: naive_pieces(t or "", i, rate, 11, vocabulary, hashed) for i, t in rows}


def test_ids_that_are_no_text_have_none(spark):
    from graphloom.llm import pieces as P

    v = P.Vocabulary(P.default_model())
    broken = [int(v.ids[P.SPACE]), int(v.byte[0xE6])]
    rows = P.decode_pieces(spark.createDataFrame([(1, broken), (2, None), (3, [])], "doc_id long, ids array<int>")).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == {1: None, 2: "", 3: ""}


def test_dropout_varies_each_occurrence(spark):
    import collections

    from graphloom.llm import pieces as P

    docs = documents(spark, [(i, "x" + " information" * 500) for i in range(4)])
    model = P.Vocabulary(P.default_model())
    names = {i: n for n, i in model.ids.items()}
    seen = collections.Counter()
    for r in P.encode_pieces(docs, 0.1).collect():
        for word in "".join(("\n" if names[i].startswith(P.SPACE) else "|") + names[i] for i in r["ids"]).split("\n")[2:]:
            seen[word] += 1
    v, word = model, " information"
    import numpy as np

    ids = np.tile(v.symbols(np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint32)), (4000, 1))
    keys = np.random.default_rng(6).integers(0, 1 << 63, 4000).astype(np.uint64)
    _, begins = P._matrix(v, ids, keys, 0.1)
    plain = (begins.sum(axis=1) == 1).mean()
    assert len(seen) > 4 and sum(seen.values()) >= 1990
    assert abs(seen[P.SPACE + "information"] / sum(seen.values()) - plain) < 0.05


# -- languages -----------------------------------------------------------------------------------------


def test_marginals_match_enumeration():
    import itertools

    import numpy as np

    from graphloom.llm.langid import marginals

    rng = np.random.default_rng(0)
    first, k = np.array([0, 1, 4, 9]), 3
    scores, trans = rng.normal(size=(9, k)), rng.normal(size=(k, k))
    got = marginals(scores, first, trans)
    for a, b in zip(first[:-1], first[1:]):
        want = np.zeros((b - a, k))
        for y in itertools.product(range(k), repeat=b - a):
            start = np.log(np.exp(trans[:, y[0]]).sum())
            s = start + sum(scores[a + i, y[i]] for i in range(b - a)) + sum(trans[y[i], y[i + 1]] for i in range(b - a - 1))
            for i, c in enumerate(y):
                want[i, c] += np.exp(s)
        assert np.allclose(got[a:b], want / want.sum(1, keepdims=True))
    long = np.array([0, 200, 1000])
    scores = rng.normal(size=(1000, k))
    alpha = np.full(k, 1 / k)
    fwd = []
    for t in range(200):
        alpha = alpha @ np.exp(trans) * np.exp(scores[t])
        alpha /= alpha.sum()
        fwd.append(alpha)
    assert np.allclose(marginals(scores, long, trans)[199], fwd[-1])


def test_languages_held_out(spark, sf_dir):
    from graphloom.llm.langid import held_out, identify_languages

    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    out = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    got = out.filter("held_out").select((F.col("lang") == F.col("lang_pred")).cast("double").alias("ok"), "score").toPandas()
    assert got["ok"].mean() > 0.97 and got["score"].between(0, 1).all()
    assert out.filter(F.col("held_out") != held_out()).count() == 0


def test_languages_edges(spark):
    from graphloom.llm.langid import accepted_documents, identify_languages

    rows = [(i, "the cat and the dog of that house") for i in range(20)] + [(100, None), (101, ""), (102, "123 !! 😀"), (None, "the dog"), (103, "é"), (104, LONG)]
    docs = documents(spark, rows)
    out = identify_languages(docs, spans=True).collect()
    assert len(out) == len(rows)
    pred = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out}
    assert pred[100] == pred[101] == pred[102] == ("und", 0.0)
    assert pred[3][0] == pred[None][0] == pred[103][0] == "en"
    assert next(r for r in out if r["doc_id"] == 0)["spans"][0]["end_word"] == 8
    assert identify_languages(docs.limit(0)).count() == 0
    assert all(r["lang_pred"] == "und" for r in identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect())
    kept = accepted_documents(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - {100, 101, 102}


def test_code_switched_text_is_labelled_in_runs():
    import numpy as np
    import pyarrow as pa

    from graphloom.llm.langid import _predict, fit

    rng = random.Random(6)
    syllables = {"aa": ["ka", "ro", "mi"], "bb": ["zu", "bl", "fe"]}
    word = lambda lang: "".join(rng.choice(syllables[lang]) for _ in range(3))
    texts = [(lang, " ".join(word(lang) for _ in range(60))) for lang in syllables for _ in range(20)]
    model = fit([t for _, t in texts], [lang for lang, _ in texts], 20)
    mixed = " ".join([word("aa") for _ in range(30)] + [word("bb") for _ in range(20)])
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([False]), pa.array([mixed])], ["doc_id", "held_out", "text"])
    spans = next(iter(_predict(model, True)(iter([batch]))))["spans"].to_pylist()[0]
    assert [(s["first_word"], s["end_word"], s["lang"]) for s in spans] == [(0, 30, "aa"), (30, 50, "bb")]
    assert np.diag(model.transitions).min() > 0


def test_words_end_at_spaces_of_all_kinds_and_long_runs_are_read_whole():
    import numpy as np
    import pyarrow as pa

    from graphloom.llm.langid import _predict, fit, words_of

    rng = random.Random(6)
    syllables = {"aa": ["ka", "ro", "mi"], "bb": ["zu", "bl", "fe"]}
    word = lambda lang: "".join(rng.choice(syllables[lang]) for _ in range(3))
    texts = [(lang, " ".join(word(lang) for _ in range(60))) for lang in syllables for _ in range(20)]
    model = fit([t for _, t in texts], [lang for lang, _ in texts], 20)
    many = lambda lang, n, by: by.join(word(lang) for _ in range(n))
    rows = [many("aa", 3, "\u00a0") + "\u3000" + many("bb", 30, "\u00a0"), many("aa", 4, "") + many("bb", 60, ""), many("aa", 20, " ") + " " + many("bb", 20, " ")]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([False] * 3), pa.array(rows)], ["doc_id", "held_out", "text"])
    out = next(iter(_predict(model, True, names=("lang_pred", "score", "sure"))(iter([batch])))).to_pylist()
    assert [r["lang_pred"] for r in out[:2]] == ["bb", "bb"] and out[0]["spans"][-1]["end_word"] == 33
    assert out[2]["score"] < 0.6 < 0.9 < out[2]["sure"]
    data = np.frombuffer(b"x" * 100 + b" yy", np.uint8)
    w = words_of(data, np.array([0, 101, len(data)]))
    assert w.starts.tolist() == [0, 48, 96, 101] and w.ends.tolist() == [48, 96, 100, 103] and w.first.tolist() == [0, 3, 4]


def test_the_gradient_is_that_of_the_likelihood():
    """fit's step against finite differences of the log-likelihood by enumeration."""
    import itertools

    import numpy as np

    from graphloom.llm.langid import marginals

    rng = np.random.default_rng(1)
    scores, trans, truth = rng.normal(size=(4, 2)), rng.normal(size=(2, 2)), [0, 1, 1, 0]
    first = np.array([0, 4])

    def score(y, s, t):
        return np.log(np.exp(t[:, y[0]]).sum()) + sum(s[i, y[i]] for i in range(4)) + sum(t[y[i], y[i + 1]] for i in range(3))

    def likelihood(s):
        every = [score(y, s, trans) for y in itertools.product(range(2), repeat=4)]
        return score(truth, s, trans) - np.log(np.exp(every).sum())

    p = marginals(scores, first, trans)
    for i in range(4):
        for j in range(2):
            step = np.zeros_like(scores)
            step[i, j] = 1e-5
            slope = (likelihood(scores + step) - likelihood(scores - step)) / 2e-5
            assert abs(slope - ((truth[i] == j) - p[i, j])) < 1e-6


def test_fitting_takes_the_sample_in_parts(monkeypatch):
    """In parts of any size the weights are the same, and the memory doesn't grow with words times languages squared."""
    import tracemalloc

    from graphloom.llm import langid as L

    rng = np.random.default_rng(8)
    texts = [" ".join(f"{chr(97 + lang)}{chr(97 + int(x))}q" for x in rng.integers(0, 26, 60)) for lang in range(6) for _ in range(20)]
    labels = [f"l{i // 20}" for i in range(120)]
    whole = L.fit(texts, labels, rounds=5)
    monkeypatch.setattr(L, "FIT_WORDS", 500)
    parts = L.fit(texts, labels, rounds=5)
    assert np.allclose(whole.weights, parts.weights, atol=1e-4) and np.allclose(whole.transitions, parts.transitions, atol=1e-6)
    monkeypatch.setattr(L, "FIT_WORDS", 20_000)
    many = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + int(x))}" for x in rng.integers(0, 26, 400)) for i in range(100) for _ in range(8)]
    tracemalloc.start()
    L.fit(many, [f"l{i // 8}" for i in range(800)], rounds=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 30


def test_helpers_agree():
    assert len(shingles("A b C d e f")) == 2 and hashlib.sha256(b"").hexdigest() == brute_repeats([(1, None)])[1][2]


# -- hashes, keys that many rows share, and rows that share an id ----------------------------------------


def thue_morse(bits: int) -> str:
    """A word over a and b that collides with its complement under every polynomial hash over a power of two."""
    word = "a"
    for _ in range(bits):
        word += word.translate({97: 98, 98: 97})
    return word


def test_hashes_tell_patterned_words_apart(spark):
    import numpy as np
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    from graphloom.llm.neardup import near_duplicates
    from graphloom.llm.packing import default_tokenizer, pack_documents
    from graphloom.llm.pieces import default_model, encode_pieces
    from graphloom.llm.substring import remove_repeats
    from graphloom.llm.words import SPACED, Words

    a = thue_morse(12)
    b = a.translate({97: 98, 98: 97})
    data = np.frombuffer(f"{a} {b} {a}".encode(), np.uint8)
    for seed in (5, 6, 17, 23):
        x, y, z = Words(data, np.array([0, len(data)]), SPACED).hashes(seed).tolist()
        assert x == z != y
    # as words, and as passages of words
    rows = [(1, f"{a} {BASE}"), (2, f"{b} {BASE}"), (3, a), (4, b), (5, " ".join(a)), (6, " ".join(b))]
    docs = documents(spark, rows)
    got = by_id(near_duplicates(docs))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_components(rows)
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in by_id(remove_repeats(docs)).items()} == brute_repeats(rows)
    tok = Tokenizer.from_file(default_tokenizer())
    crc = lambda t: zlib.crc32(b"".join(x.to_bytes(4, "little") for x in [*tok.encode(t, add_special_tokens=False).ids, 1]))
    packed = {r["doc_id"]: r["ids_crc32"] for r in pack_documents(docs.filter("doc_id < 5"), 100_000).collect()}
    assert packed == {i: crc(t) for i, t in rows[:4]}
    model = SentencePieceProcessor(model_file=default_model())
    assert {r["doc_id"]: r["ids"] for r in encode_pieces(docs, 0.0).collect()} == {i: model.encode(t) for i, t in rows}


def test_rows_that_share_an_id_keep_their_own_texts(spark):
    from graphloom.llm.neardup import near_duplicates, one_of_each_group
    from graphloom.llm.substring import remove_repeats, without_repeats

    other = " ".join(f"other{i}" for i in range(50))
    rows = [(1, BASE), (2, other), (2, BASE), (2, None), (3, other), (2, other), (4, "")]
    docs = documents(spark, rows)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect())
    assert got == sorted([(1, 56, 1, True), (2, 46, 2, True), (2, 56, 1, False), (2, 0, 2, True), (3, 46, 2, False), (2, 46, 2, True), (4, 0, 4, True)])
    left = one_of_each_group(docs)
    assert sorted((r["doc_id"], r["text"] or "") for r in left.collect()) == sorted([(1, BASE), (2, other), (2, ""), (4, "")])
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in remove_repeats(docs).collect())
    assert got == sorted([(1, 60, 0), (2, 50, 0), (2, 60, 60), (2, 0, 0), (3, 50, 50), (2, 50, 0), (4, 0, 0)])
    assert without_repeats(docs).count() == len(rows)


def test_common_keys_take_their_own_way(spark, crowd, monkeypatch):
    """With every key counted as common, and leaders' texts sent out for two members each, results are the same."""
    from graphloom.llm import neardup as N
    from graphloom.llm import substring as S
    from graphloom.operators import frames

    monkeypatch.setattr(N, "LEADER_ROWS", 2)
    monkeypatch.setattr(N, "SAMPLED", 1)
    monkeypatch.setattr(S, "SAMPLED", 1)
    rng = random.Random(8)
    line = " ".join(f"l{i}" for i in range(4))
    rows = crowd + [(1000 + i, " ".join(f"{rng.randrange(99)}q" if j % 12 else line for j in range(80))) for i in range(40)]
    monkeypatch.setattr(frames, "FEW_ROWS", 0)
    for heavy in (1, 4096):
        monkeypatch.setattr(frames, "HEAVY_KEYS", heavy)
        got = by_id(N.near_duplicates(documents(spark, rows)))
        assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_components(rows)
        got = by_id(S.remove_repeats(documents(spark, rows)))
        assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == brute_repeats(rows)


def test_exact_links_need_no_common_key(spark, crowd, monkeypatch):
    from graphloom.llm import neardup as N

    monkeypatch.setattr(N, "_bucket_members", lambda classes: spark.createDataFrame([], "key long, node long, size long"))
    got = by_id(N.near_duplicates(documents(spark, crowd), exact=True))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_components(crowd)
