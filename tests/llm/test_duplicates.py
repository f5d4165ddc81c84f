"""Operators that compare texts or vectors with each other, against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetmill.llm import components, jaccard, lines, neighbours, suffix


def union(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, text, n, alphabet):
    text = list(text)
    for _ in range(n):
        at, how = rng.randrange(len(text)), rng.random()
        if how < 0.4:
            text[at] = rng.choice(alphabet)
        elif how < 0.7:
            text.insert(at, rng.choice(alphabet))
        elif len(text) > 1:
            text.pop(at)
    return text


@pytest.mark.parametrize("few", [0, 1_000])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW_LINKS", few)
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)] + [(5, 5), (None, 3)]
    out = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    expected = union(real, {x for p in real for x in p})
    assert out == expected
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def jaccard_expected(docs, num=80, den=100):
    sets = {i: jaccard.shingles(t or "", 5) for i, t in docs}
    t = jaccard.Threshold(num, den)
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if sets[a] and jaccard.similar(sets[a], sets[b], t)]
    return {i: (len(sets[i]), c) for i, c in union(links, ids).items()}


def test_jaccard_join_equals_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = [(-1, ""), (-2, None), (-3, "a b"), (-4, "A  b"), (-5, " \n "), (-6, "a"), (-7, "one two three four five six seven eight nine ten"), (-8, "one two three four five six seven eight nine")]
    for base in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([5, 6, 8, 12, 20, 40, 90, 200]))]
        docs += [(100 * base + k, " ".join(changed(rng, words, rng.choice([0, 0, 1, 2, 3]), vocabulary))) for k in range(rng.choice([1, 3, 8]))]
    common = " ".join(rng.choice(vocabulary) for _ in range(60))
    docs += [(9000 + k, " ".join(changed(rng, common.split(), k % 3, vocabulary))) for k in range(60)]  # more probe one entry than are listed as pairs
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, a long")
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(frame).collect()}
    assert out == jaccard_expected(docs)
    assert jaccard.similar_components(frame.limit(0)).count() == 0


def test_large_meetings_equal_brute_force(spark, monkeypatch):
    for name, value in {"SOME": 6, "BLOCK": 16, "SKETCH_BLOCK": 32}.items():
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(300)]
    passage, other = ([rng.choice(vocabulary) for _ in range(n)] for n in (40, 70))
    docs = [(k, " ".join(changed(rng, passage, k % 6, vocabulary))) for k in range(90)]
    docs += [(1000 + k, " ".join([*passage, *(rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 60])))])) for k in range(90)]
    docs += [(2000 + k, " ".join(changed(rng, [*passage, *other], k % 9, vocabulary))) for k in range(60)]
    docs += [(None, docs[0][1]), (None, ""), (5, docs[5][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    out = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_components(frame).collect()}
    expected = {(i, *x) for i, x in jaccard_expected([d for d in docs if d[0] is not None]).items()}
    assert out == expected | {(None, len(jaccard.shingles(docs[0][1], 5)), None), (None, 0, None)}
    assert len({c for *_, c in out}) > 20


def test_sketches_rule_out_no_similar_sets():
    rng = np.random.default_rng(3)
    for n in (1, 7, 60, 900):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        for gone, new in ((0, 0), (n // 9, n // 9), (n // 2, n)):
            b = np.concatenate([a[gone:], rng.integers(0, 1 << 63, new).astype(np.uint64)])
            texts, sizes = np.repeat([0, 1], [len(a), len(b)]), np.array([len(a), len(b)])
            parts = jaccard.sketches(texts, np.concatenate([a, b]), sizes)
            x, y = jaccard.folded(parts, min(map(len, parts)))
            differ = int(np.bitwise_count(x ^ y).sum())
            assert differ <= gone + new and (gone + new < 20 or differ > 0.35 * (gone + new))


@pytest.mark.parametrize("threshold", [0, 1, 2])
def test_line_dedup_equals_brute_force(spark, threshold):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(18, 36))) for _ in range(25)]
    docs = [(i, "\n".join("".join(changed(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3]), "abcé")) for _ in range(rng.randint(1, 5)))) for i in range(50)] + [(900, None), (901, ""), (902, "\n\n")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, line string")
    all_lines = [(i, j, x) for i, t in docs for j, x in enumerate((t or "").split("\n")) if len(x) >= 20]
    expected = {}
    for n, (i, j, x) in enumerate(all_lines):
        for i2, j2, y in all_lines[:n]:
            if abs(len(x) - len(y)) <= threshold and edits(x, y) <= threshold:
                expected[i, j] = (i2, j2)
                break
    out = {(r.doc_id, r.line_no): (r.first_doc, r.first_line) for r in lines.removed_lines(frame, threshold, 20).collect()}
    assert out == expected
    kept = {r.doc_id: r.text for r in lines.dedup_lines(frame, threshold, 20).collect()}
    assert kept == {i: None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if (i, j) not in expected) for i, t in docs}
    assert lines.removed_lines(frame.limit(0), threshold, 20).count() == 0


def test_short_copies_go_in_query_and_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = [(1, "Les.\n\nAnd ornd.\n \t"), (2, "Les.\nLet.\n\n \t\nAnd ornd."), (3, "é"), (4, "é\né"), (5, None), (6, "a line of twenty-one\nLes. "), (7, "a line of twenty-onE\nLes. ")]
    frame = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, n_chars long")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    out = {(r.doc_id, r.line_no): (r.first_doc, r.first_line) for r in lines.query(spark, str(tmp_path)).collect()}
    assert out == {(2, 0): (1, 0), (2, 4): (1, 2), (4, 0): (3, 0), (4, 1): (3, 0), (7, 0): (6, 0), (7, 1): (6, 1)}
    kept = {r.doc_id: r.text for r in corpus_pipeline.fresh_lines(spark, frame, "").collect()}
    assert kept == dict(docs) | {2: "Let.\n\n \t", 4: "", 7: ""}


def test_line_dedup_of_null_and_repeated_ids_and_clashing_names(spark):
    same, other, third = "a line that is long enough", "another line, long enough", "a third line of some length"
    docs = [(5, f"{same}\n{other}", "a"), (5, f"{third}\nclean and long enough to be judged", "b"), (None, f"{other}\nfirst of all", "c"), (None, f"{third}\n{third}", "d"), (7, f"{other}\nkept, as it is new here", "e"), (7, f"{other}\nkept, as it is new here", "f")]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, gone string, copy string, row int")
    out = lines.dedup_lines(frame)
    assert out.columns == frame.columns
    kept = {r.gone: r.text for r in out.collect()}
    assert kept == {"a": same, "b": "clean and long enough to be judged", "c": docs[2][1], "d": third, "e": "kept, as it is new here", "f": "kept, as it is new here"}


def test_near_copies_of_very_long_lines(spark):
    rng = random.Random(6)
    line = "".join(rng.choice("abcdé ") for _ in range(300_000))
    docs = [(1, line), (2, line[:280_000] + "X" + line[280_001:]), (3, line[:20_000] + line[20_001:]), (4, line[:280_000] + "VWZ" + line[280_003:])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.first_doc for r in lines.removed_lines(frame, 1, 20).collect()} == {2: 1, 3: 1}


def test_lines_of_large_groups_make_no_pairs(spark, monkeypatch):
    rng = random.Random(8)
    base = "".join(rng.choice("abcdé😀 ") for _ in range(40))
    texts = [base, *("".join(changed(rng, base, rng.choice([1, 1, 2, 3]), "abé😀")) for _ in range(150)), *(base[:20] + f"{i:020d}" for i in range(100, 160))]
    rng.shuffle(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = {}
    for i, x in enumerate(texts):
        first = next((j for j, y in enumerate(texts[:i]) if len(x) >= 20 <= len(y) and abs(len(x) - len(y)) <= 1 and edits(x, y) <= 1), None)
        if first is not None:
            expected[i] = first
    joined = []
    plain = lines.near_pairs
    monkeypatch.setattr(lines, "near_pairs", lambda rows, shared, threshold: joined.append(shared.groupBy("key").count().agg(F.max("count")).first()[0]) or plain(rows, shared, threshold))
    out = {r.doc_id: r.first_doc for r in lines.removed_lines(frame, 1, 20).collect()}
    assert out == expected and len(out) > 100
    assert (joined[0] or 0) <= lines.GROUP


def generated(plan):
    """Rows that the generators of an executed plan made."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return generated(plan.executedPlan())
    if "QueryStage" in name:
        return generated(plan.plan())
    own = plan.metrics().apply("numOutputRows").value() if name.startswith("Generate") else 0
    return own + sum(generated(plan.children().apply(i)) for i in range(plan.children().size()))


def test_lines_of_large_groups_make_no_row_a_character(spark, monkeypatch):
    rng = random.Random(9)
    base = "".join(rng.choice("abcdé ") for _ in range(600))
    texts = [base[:300] + "".join(rng.choice("abcdé ") for _ in range(300)) for _ in range(100)] + [base[:500] + f"{i:02d}" + base[502:] for i in range(0, 100, 3)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    expected = {i: next(j for j, y in enumerate(texts) if j >= 100 and edits(x[498:504], y[498:504]) <= 1) for i, x in enumerate(texts) if i >= 100}
    made = []
    plain = lines.cut
    monkeypatch.setattr(lines, "cut", lambda rows: made.append(lines.PIECES * rows.count()) or plain(rows))
    out = lines.removed_lines(frame, 1, 20)
    assert {r.doc_id: r.first_doc for r in out.collect()} == {i: j for i, j in expected.items() if i != j}
    assert generated(out._jdf.queryExecution().executedPlan()) + sum(made) <= 40 * len(texts)


def test_repeated_bytes_equal_brute_force(spark):
    rng = random.Random(4)
    letters = "abcdefgh é"
    passages = ["".join(rng.choice(letters) for _ in range(n)) for n in (99, 100, 101, 150, 400)]
    docs = [(1, None), (2, ""), (3, "x" * 99), (4, "x" * 99), (5, "y" * 100), (6, "y" * 100), (7, "a" * 500), (8, "abc" * 100), (9, "é" * 60), (10, "é" * 60)]
    for i in range(20, 60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(rng.randint(1, 200))) for _ in range(rng.randint(1, 5))]
        docs.append((i, "".join(parts)))
    docs += [(70, docs[-1][1]), (71, docs[-2][1])]
    seen, expected = set(), {}
    for i, t in sorted(docs):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - 99):
            if raw[at : at + 100] in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(raw[at : at + 100])
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for at in range(len(raw)) if gone[at] and (at == 0 or not gone[at - 1]))
        expected[i] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    frame = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, part long")
    nulls = suffix.remove_repeats(spark.createDataFrame([(None, passages[2]), (1, "a" + passages[2]), (None, None)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in nulls) == [(0, 0, 0), (0, 101, 0), (1, 102, 101)] or len(passages[2].encode()) != 101
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.remove_repeats(frame).collect()}
    assert out == expected
    assert suffix.remove_repeats(frame.limit(0)).count() == 0


def test_passages_stage_keeps_rows_with_null_and_repeated_ids(spark):
    import corpus_pipeline

    rng = random.Random(7)
    p, q, r = ("".join(rng.choice("abcdefgh é") for _ in range(150)) for _ in range(3))
    docs = [(5, p, "a"), (5, p, "a"), (5, q, "b"), (None, r, "c"), (None, r + "x", "d"), (6, r + "." + q, "e"), (7, None, "f"), (8, "short", "g"), (8, "short", "h")]
    seen, expected = set(), []
    for i, t, lang in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        raw = (t or "").encode()
        gone = set()
        for at in range(len(raw) - 99):
            if raw[at : at + 100] in seen:
                gone.update(range(at, at + 100))
            seen.add(raw[at : at + 100])
        kept = bytes(x for at, x in enumerate(raw) if at not in gone).decode(errors="ignore")
        expected.append((i, kept, lang, len(kept)))
    frame = spark.createDataFrame([(i, t, lang, len(t or "")) for i, t, lang in docs], "doc_id long, text string, lang string, n_chars long")
    out = corpus_pipeline.fresh_passages(spark, frame, "")
    assert out.columns == frame.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(expected, key=str)


def test_maximal_repeats():
    strings = [b"xx" + b"0123456789" * 3 + b"ab", b"yy" + b"0123456789" * 3 + b"cd", b"zz0123456789zz"]
    found = {(size, tuple(sorted(zip(which.tolist(), place.tolist(), strict=True)))) for size, which, place in suffix.maximal_repeats(strings, 10)}
    assert (30, ((0, 2), (1, 2))) in found
    assert any(size == 10 and (2, 2) in at and len(at) == 7 for size, at in found)


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(120, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, (base[i % 10] + 0.05 * rng.normal(size=16)).tolist()) for i in range(60)]
    rows += [(2000 + i, base[3].tolist()) for i in range(5)]
    bad = [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [float("nan")] * 16), (3004, [None] * 16), (3005, [float("inf")] * 16)]
    frame = spark.createDataFrame([(i, v, 7) for i, v in rows + bad], "vec_id long, embedding array<double>, node int")
    out = {r.vec_id: r for r in neighbours.near_duplicates(frame, block=16).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    ids = [i for i, _ in rows]
    links = {i: int(near[k].sum()) - 1 for k, i in enumerate(ids)}
    found = sum(out[i].n_links for i in ids)
    assert all(out[i].n_links <= links[i] for i in ids) and found >= 0.95 * sum(links.values())
    expected = union([(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True) if a < b], ids)
    assert sum(out[i].component_id == expected[i] for i in ids) >= 0.95 * len(ids)
    assert all(out[i].n_links == 0 and out[i].component_id == i and out[i].kept for i, _ in bad)
    assert neighbours.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("few", ["queries", "cells"])
def test_neighbours_are_all_found_when_cells_cannot_tell(spark, monkeypatch, few):
    for name, value in {"queries": {"SAMPLE": 20, "QUERIES": 20}, "cells": {"MOST_CELLS": 1}}[few].items():
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(800, 16))
    x = np.concatenate([x, x[:150] + 0.4 * rng.normal(size=(150, 16))])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_duplicates(frame, block=128).collect()}
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    component = union([(int(a), int(b)) for a, b in zip(*np.nonzero(near), strict=True) if a < b], range(len(x)))
    assert near.sum() > len(x) + 100
    assert out == {i: (int(near[i].sum()) - 1, component[i]) for i in range(len(x))}


def test_pipeline_stages_follow_each_other(spark, tmp_path):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns and docs.count() <= before, name
            before = docs.count()
    assert docs.agg({"length": "max"}).first()[0] <= 1024
