"""Operators on single texts: formatting, toxicity, codec, quality rules and packing."""

import base64
import hashlib
import math
import struct
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sheetmill.llm import bpe, chat, packing, quality, toxicity

SF = "/root/testdata/sf0.001"
ODD = [(1, ""), (2, None), (3, " a  b   c \n \n d<|endoftext|> x  y  "), (4, "  "), (5, "\n a"), (6, "it's 's  's\t\tx é  z"), (7, "word " * 3000), (8, "日本 語 x  y"), (8, "日本 語 x  y")]
SCHEMA = "doc_id long, text string, part string, words int"


def odd(spark):
    """Odd texts with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "p", 1) for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def files():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f, open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as g:
        return f.read(), g.read()


def test_codec_equals_tiktoken_and_comes_back(spark, files):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, files[0].splitlines())}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionAll(odd(spark).select("doc_id", "text"))
    texts = sorted((r.doc_id, r.text or "") for r in docs.collect())
    expected = sorted((i, len(ids := enc.encode_ordinary(t)), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts)
    assert sorted(tuple(r) for r in bpe.digests(docs, files[0], public_tokenizers.PATTERN).collect()) == expected
    encoded = bpe.encode(odd(spark), files[0], public_tokenizers.PATTERN)
    back = bpe.decode(encoded, files[0], public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id, bytes(r.data).decode()) for r in back) == sorted((i, t or "") for i, t in ODD)
    assert bpe.digests(odd(spark).limit(0), files[0], public_tokenizers.PATTERN).count() == 0


def test_packing_keeps_every_id_within_capacity(spark, files):
    tokenizer = Tokenizer.from_str(files[1])
    docs = odd(spark).dropDuplicates(["doc_id"]).select("doc_id", "text").unionAll(spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id + 100", "text"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    out = packing.pack(packing.pieces(docs, files[1]), groups=2).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    for doc, text in texts.items():
        ids, at = [*tokenizer.encode(text, add_special_tokens=False).ids, 2], 0
        for r in sorted(pieces[doc], key=lambda r: r.piece):
            assert r.start == at and r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at : at + r.length]))
            at += r.length
        assert at == len(ids) and len(pieces[doc]) == math.ceil(len(ids) / 1024)
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(bins) <= math.ceil(sum(r.length for r in out) / 1024) + 4
    limited = packing.pack(packing.pieces(docs, files[1]), max_docs=3, max_attention=600_000.0).collect()
    bins = defaultdict(list)
    for r in limited:
        bins[r.sequence_id].append(r.length)
    assert all(len(b) <= 3 and (sum(x * x for x in b) <= 600_000 or len(b) == 1) for b in bins.values())


def test_packing_workers_keep_few_units(files):
    """A worker lives on through later stages, so what it keeps of texts is bounded; ids stay those of the file."""
    ids_of = packing.TokenizerIds(files[1])
    for i in range(30):
        text = " ".join(f"w{i}x{j}" for j in range(10_000))
        raw = ids_of.raw(text)
    assert list(struct.unpack(f"<{len(raw) // 4}I", raw)) == Tokenizer.from_str(files[1]).encode(text, add_special_tokens=False).ids
    assert len(ids_of.units.first) + len(ids_of.units.rest) <= 120_000


def test_chat_equals_sql_and_reads_back(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    out = chat.query(spark, SF)
    assert sorted(tuple(r[c] for c in out.columns) for r in out.collect()) == sorted(con.execute(f"SELECT {', '.join(out.columns)} FROM ({chat.SQL})").fetchall())
    hostile = [(1, 0, "us\\er\n<|x", "<|im_end|>\n<|im_start|>assistant ok"), (1, 0, None, None), (1, None, "assistant", "<\\|a<\\\\|"), (None, 1, "assistant", ""), (2, 5, "assistant", "x" * 50), (2, 6, "user", "y")]
    turns = chat.from_turn_rows(spark.createDataFrame(hostile, chat.TURNS))
    parts = chat.format_turns(turns, part_chars=30).collect()
    texts = defaultdict(str)
    for r in sorted(parts, key=lambda r: (r.conv_id or 0, r.part)):
        texts[r.conv_id] += r.formatted
    assert chat.read_back(texts[1]) == [("assistant", "<\\|a<\\\\|"), ("", ""), ("us\\er\n<|x", "<|im_end|>\n<|im_start|>assistant ok")]
    assert len([r for r in parts if r.conv_id == 2]) == 2
    assert chat.digests(chat.format_turns(turns.limit(0))).count() == 0


def test_layouts_are_found_by_fingerprint(spark):
    records = [
        (1, '{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}'),
        (2, '{"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}'),
        (3, '{"output": "b", "instruction": "a", "input": ""}'),
        (4, '{"prompt": "a", "completion": "b"}'),
        (5, '{"other": 1}'),
        (6, "no json"),
        (7, None),
    ]
    out = chat.from_json(spark.createDataFrame(records, "id long, raw string"), "id", "raw").collect()
    turns = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.conv_id, r.turn or 0)):
        turns[r.conv_id].append((r.role, r.text))
    assert all(turns[i] == [("user", "a"), ("assistant", "b")] for i in (1, 2, 3, 4))
    hostile = [
        (20, "[" * 100_000), (21, '{"messages": [{"role": "user", "content": "\\ud800x"}]}'), (22, '{"id": 7, "messages": [{"role": "user", "content": "a", "name": "n"}, 5], "source": "s"}'),
        (23, '{"messages": []}'), (24, '{"system": "s", "instruction": "i", "output": "o"}'), (25, '{"messages": "none"}'), (26, '{"a": ' * 5000 + "1" + "}" * 5000), (27, '{"\\ud800": 1}'),
    ]
    odd = defaultdict(list)
    for r in chat.from_json(spark.createDataFrame(hostile, "id long, raw string"), "id", "raw").collect():
        odd[r.conv_id].append((r.turn, r.role, r.text, r.layout))
    assert odd[20] == odd[26] == odd[27] == [(None, None, None, None)]
    assert odd[21] == [(0, "user", "\ufffdx", "messages")] and odd[22] == [(0, "user", "a", "messages")]
    assert odd[23] == odd[25] == [(None, None, None, "messages")]
    assert [x[1:3] for x in odd[24]] == [("system", "s"), ("user", "i"), ("assistant", "o")]
    wide = spark.createDataFrame([(1, 0, "user", "a", 5)], "conv_id int, turn int, role string, text string, extra int")
    assert [tuple(r) for r in chat.from_turn_rows(wide).collect()] == [(1, 0, "user", "a")]
    assert all(turns[i] == [(None, None)] for i in (5, 6, 7)) and next(r for r in out if r.conv_id == 5).fingerprint


def test_toxicity_on_held_out_rows(spark):
    docs = [(i, f"{'some plain words here and there ' * 4}{'you idiots are scum ' if i % 4 == 0 else 'you friends are kind '}{i}") for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(500)] + [(7, None), (None, 1)], "doc_id long, toxic int")
    frame = spark.createDataFrame([*docs, (9000, None), (9001, ""), (None, "you idiots")], "doc_id long, text string")
    out = {r.doc_id: r for r in toxicity.score(frame, labels).collect()}
    assert len(out) == 603 and all(0 <= r.score <= 1 for r in out.values())
    unseen = [i for i in range(600) if i >= 500 or zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(out[i].predicted == int(i % 4 == 0) for i in unseen) >= 0.95 * len(unseen)
    kept = {r.doc_id for r in toxicity.keep_ordinary(frame, labels).collect()}
    assert kept == {i for i, r in out.items() if not r.predicted}
    assert {r.predicted for r in toxicity.score(frame, labels.limit(0)).collect()} == {0}
    assert toxicity.score(frame.limit(0), labels).count() == 0


def plain_kneser_ney(rows, d=toxicity.DISCOUNT, m=toxicity.STRENGTH):
    """log P_1 - log P_0 of a character after a start, by dictionaries."""
    n = [defaultdict(int), defaultdict(int)]
    for label, text in rows:
        for w in toxicity.words(text):
            padded = toxicity.START + w + toxicity.STOP
            for i in range(len(w) + 1):
                n[label][padded[i : i + toxicity.ORDER]] += 1
    kinds = {}
    kinds[toxicity.ORDER] = set(n[0]) | set(n[1])
    for k in range(toxicity.ORDER - 1, 0, -1):
        kinds[k] = {g[1:] for g in kinds[k + 1]}

    def s(g):
        k = len(g)
        before = lambda x: sum(1 for e in kinds[k + 1] if e[1:] == x)
        if k == 1:
            return (before(g) + 1) / (len(kinds[2]) + len(kinds[1]) + 1)
        after = [x for x in kinds[k] if x[:-1] == g[:-1]]
        total = sum(map(before, after))
        return (max(before(g) - d, 0) + d * len(after) * s(g[1:])) / total

    def ratio(h, x):
        pooled = {g: n[0].get(g, 0) + n[1].get(g, 0) for g in kinds[toxicity.ORDER] if g[:-1] == h}
        t = sum(pooled.values())
        shared = (max(pooled.get(h + x, 0) - d, 0) + d * len(pooled) * s((h + x)[1:])) / t
        p = []
        for c in (0, 1):
            own = {g: k for g, k in n[c].items() if g[:-1] == h}
            p.append((max(own.get(h + x, 0) - d, 0) + (m + d * len(own)) * shared) / (sum(own.values()) + m))
        return math.log(p[1] / p[0])

    return kinds[toxicity.ORDER], ratio


def test_toxicity_equals_plain_kneser_ney(spark):
    rows = [(0, "Plain words, here and there."), (0, "words  and wordy WORDS"), (1, "rude words, rude (rudely) é日本"), (1, "and rude"), (0, ""), (0, "...")]
    kinds, ratio = plain_kneser_ney(rows)
    counts = toxicity.count_expressions(spark.createDataFrame(rows, "label int, text string"))
    seen, starts = toxicity.differences(counts)
    found = {r.g: r.r for r in seen.collect()}
    assert found.keys() == kinds
    assert all(abs(found[g] - ratio(g[:-1], g[-1])) < 1e-9 for g in kinds)
    # an unseen expression after a seen start: the shared backoff cancels out
    models = toxicity.Models(*(toxicity.slotted(x, 1 << 40) for x in (seen, starts)))
    for word in ("rude", "wordz", "rudex", "zzz", "é日"):
        padded = toxicity.START + word + toxicity.STOP
        known = {g[:-1] for g in kinds}
        expected = 0.0
        for i in range(len(word) + 1):
            h, x = padded[i : i + toxicity.ORDER - 1], padded[i + toxicity.ORDER - 1]
            if h + x in kinds:
                expected += ratio(h, x)
            elif h in known:
                expected += next(r.r for r in starts.collect() if r.g == h)
        assert abs(models.of_words([word])[0] - expected) < 1e-5
    few = toxicity.Models(*(toxicity.slotted(x, 4) for x in (seen, starts)))
    assert len(few.seen[0]) <= 4 and len(few.starts[0]) <= 4


def test_toxicity_keeps_all_expressions_in_parts(spark):
    rows = [(i % 2, f"{'rude' if i % 2 else 'plain'} {'abcdefghij'[i % 10] * 3}{i} words") for i in range(40)]
    tables = toxicity.differences(toxicity.count_expressions(spark.createDataFrame(rows, "label int, text string")))
    one, many = (toxicity.Models(*(toxicity.slotted(x, n) for x in tables)) for n in (1 << 20, 40))
    words = sorted({w for _, t in rows for w in toxicity.words(t)}) + ["unseen", "rudely", "plainest"]
    assert many.of_words(words) == one.of_words(words)
    assert [sum(map(len, x)) for x in (many.seen, many.starts)] == [x.count() for x in tables]
    assert len(one.seen) == 1 < len(many.seen) and all(len(x) <= 40 for x in (*many.seen, *many.starts))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(many.of_words(batch.column(0).to_pylist()))], names=["w", "x"])

    found = {r.w: r.x for r in spark.createDataFrame([(w,) for w in words], "w string").mapInArrow(run, "w string, x double").collect()}
    assert found == dict(zip(words, one.of_words(words), strict=True))


def test_quality_equals_sql(spark, tmp_path):
    rows = [*ODD, (20, "a b c d e f g h a b c d e f g h"), (21, "x " * 40), (22, "l1\nl2\nl1\n \n \nl1"), (23, "#|<> $%&*")]
    docs = spark.createDataFrame([(i, t, "p", 1) for i, t in rows if i != 8], SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    out = quality.query(spark, str(tmp_path))
    assert sorted(tuple(r[c] for c in out.columns) for r in out.collect()) == sorted(con.execute(f"SELECT {', '.join(out.columns)} FROM ({quality.SQL})").fetchall())
    rules = quality.ordered([(r, c, s) for r, c, s in zip(quality.RULES, (1, 2, 1, 1, 1), (0.1, 0.4, 0.0, 0.3, 0.1), strict=True)])
    assert [r.name for r in rules][:2] == ["symbols", "repeated windows"]
    assert quality.cascade(docs.limit(0)).count() == 0
    kept = {r.doc_id for r in quality.screen(docs.withColumn("reason", F.lit(1))).collect()}
    assert kept == {r.doc_id for r in out.collect() if r.kept}


def test_quality_rules_after_a_rejection_cost_nothing(spark):
    docs = spark.createDataFrame([(i, f"word {i} " * 9, "x") for i in range(50)] + [(None, None, None)], "doc_id long, text string, n_words string")
    every = quality.Rule("every", ("n_words",), lambda n: n >= 0)
    dear = quality.Rule("dear", ("n_repeat_words",), lambda r: F.when(r >= 0, F.raise_error(F.lit("paid"))).cast("boolean"))
    measure = quality.of_text(F.coalesce("text", F.lit("")))
    reasons = docs.select(quality.verdict([every, dear], measure).alias("reason"))
    assert {r.reason for r in reasons.collect()} == {"every"}
    assert docs.filter(quality.verdict([every, dear], measure).isNull()).count() == 0
    with pytest.raises(Exception, match="paid"):
        docs.select(quality.verdict([dear, every], measure)).collect()
