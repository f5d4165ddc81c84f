"""Every stage of the pipeline on its own input, against plain Python."""

import random
import zlib

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sheetmill.llm import toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, `one` long, `row` int, gone int"


def documents():
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared_line, passage = text(9), text(60)
    docs = []
    for i in range(150):
        parts = [text(rng.randint(5, 40)) for _ in range(rng.randint(1, 4))]
        if i % 5 == 0:
            parts.insert(rng.randrange(len(parts) + 1), shared_line if i % 10 else shared_line + "x")
        if i % 7 == 0:
            parts.append(f"{text(3)} {passage} {text(3)}")
        if i % 4 == 1:
            parts.append("you filthy idiots are vermin and scum " * 3)
        docs.append((i, "\n".join(parts)))
    near = docs[2][1].split(" ")
    docs += [(300 + k, " ".join([*near[:-1], w])) for k, w in enumerate(words[:3])] + [(400, docs[3][1]), (6, text(30)), (None, docs[10][1]), (None, text(30)), (500, None), (501, ""), (502, " \n "), (503, "日本 語"), (504, "w " * 3000), (500, None)]
    return [(i, t, "en", "s", len(t) if t is not None else None, "k", 1, 2, 3) for i, t in docs]


def lines_expected(docs):
    from test_duplicates import edits

    seen, out = [], []
    order = sorted(range(len(docs)), key=lambda n: (docs[n][0] is not None, docs[n][0] or 0))
    kept = {}
    for n in order:
        lines = (docs[n][1] or "").split("\n")
        left = []
        for x in lines:
            near = any(y == x or len(x) >= 20 and len(y) >= 20 and abs(len(x) - len(y)) <= 1 and edits(x, y) <= 1 for y in seen)
            if not (near and x.strip(" \t\r\x0b\x0c")):
                left.append(x)
            seen.append(x)
        kept[n] = None if docs[n][1] is None else "\n".join(left)
    for n, d in enumerate(docs):
        out.append((d[0], kept[n], *d[2:4], None if kept[n] is None else len(kept[n]), *d[5:]))
    return out


def key(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    """The documents, labels, and each stage's rows."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = documents()
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int("vermin" in t)) for i, t, *_ in docs if i is not None and t and i < 120]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    frame, stages = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = frame.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frame, folder).write.parquet(f"{folder}/{i}")
        frame = spark.read.parquet(f"{folder}/{i}")
        assert i == len(corpus_pipeline.STAGES) - 1 or frame.columns == columns
        stages.append([tuple(r) for r in frame.collect()])
    return docs, folder, stages


def test_toxicity_stage(spark, ran):
    docs, folder, stages = ran
    scored = toxicity.score(spark.createDataFrame(docs, SCHEMA), spark.read.parquet(f"{folder}/labels.parquet"))
    toxic = {r.doc_id for r in scored.collect() if r.predicted}
    assert 6 not in toxic and key(stages[0]) == key(d for d in docs if d[0] not in toxic)
    real = {d[0] for d in docs if d[1] and "vermin" in d[1] and d[0] is not None}
    clean = {d[0] for d in docs if d[0] is not None} - real
    held = {i for i in real if zlib.crc32(str(i).encode()) % 5 == 0}
    assert len(held & toxic) >= 0.9 * len(held) and len(clean & toxic) <= 0.03 * len(clean)


def test_line_stage(ran):
    _, _, stages = ran
    assert key(stages[1]) == key(lines_expected(stages[0])) and any(a[1] != b[1] for a, b in zip(key(stages[0]), key(stages[1]), strict=True))


def test_near_copy_stage(ran):
    from test_duplicates import jaccard_expected

    _, _, stages = ran
    groups = jaccard_expected([(d[0], d[1]) for d in stages[1] if d[0] is not None and d[0] != 6])  # both rows of 6 differ from all
    gone = {i for i, (_, c) in groups.items() if c != i}
    assert gone and key(stages[2]) == key(d for d in stages[1] if d[0] not in gone)


def test_passage_stage(ran):
    _, _, stages = ran
    seen, expected = set(), []
    for d in sorted(stages[2], key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        raw = (d[1] or "").encode()
        gone = set()
        for at in range(len(raw) - 99):
            if raw[at : at + 100] in seen:
                gone.update(range(at, at + 100))
            seen.add(raw[at : at + 100])
        kept = bytes(x for at, x in enumerate(raw) if at not in gone).decode(errors="ignore")
        expected.append((d[0], kept, *d[2:4], len(kept), *d[5:]))
    assert key(stages[3]) == key(expected) and sum(len(d[1]) for d in stages[3]) < sum(len(d[1] or "") for d in stages[2])


def test_packing_stage(ran):
    _, _, stages = ran
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(tokenizer.encode(d[1], add_special_tokens=False).ids) + 1 for d in stages[3])
    assert sum(r[3] for r in stages[4]) == total
    bins = {}
    for r in sorted(stages[4], key=lambda r: (r[5], r[6])):
        assert r[6] == bins.get(r[5], 0)
        bins[r[5]] = r[6] + r[3]
    assert max(bins.values()) <= 1024 and len(bins) <= -(-total // 1024) + 3


def test_empty_tables(spark, ran):
    docs, folder, _ = ran
    frame = spark.createDataFrame(docs, SCHEMA).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame, folder).count() == 0
