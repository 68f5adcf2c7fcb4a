"""The operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns, against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zipfile
from collections import Counter
from io import BytesIO

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from relweave.llm import chat, components, decontam, embeddings, langid, minhash, mixing, pii, quality, rules, tokens, warc
from relweave.llm.queries import QUERIES, ORACLE_SQL, tokenizer_path
from tests.compare import connect, same
from tests.llm import brute

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, regs string, rep int, score double"


def _words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def _docs(rows):
    """Rows with columns that have names the operators use inside."""
    return [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), "x", 1, 0.5) for i, t in rows]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out: dict[int, str | None] = {0: None, 1: "", 2: " \n\t ", 3: "one", 4: "ONE", 5: "two words", 6: "a b c d", 7: "A b\tc\nd"}
    base = [_words(rng, n) for n in (30, 60, 200, 12, 90)]
    k = 8
    for b in base:
        for edits in (0, 0, 1, 2, 3, 5, 9):
            w = list(b)
            for _ in range(edits):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            out[k] = " ".join(w)
            k += 1
    for _ in range(30):
        out[k] = " ".join(_words(rng, rng.randrange(1, 80)))
        k += 1
    out[k] = " ".join(_words(rng, 60_000, 10**6))
    out[k + 1] = "é" * 50_000
    return out


@pytest.mark.parametrize(("n", "percent"), [(4, 80), (5, 80)])
def test_minhash(spark, texts, n, percent):
    df = spark.createDataFrame([*_docs(texts.items()), *_docs([(None, "a b c d")])], DOC)
    got = {r.doc_id: r for r in minhash.near_duplicates(df, n, percent).collect()}
    want = brute.near(texts, n, percent)
    assert {i: (got[i].n_shingles, got[i].component_id) for i in texts} == want
    assert all(got[i].kept == (got[i].component_id == i) for i in texts)
    assert got[None].component_id is None and got[None].kept is None


def test_minhash_in_blocks(spark, texts, monkeypatch):
    """Clusters over several blocks, and buckets beyond a block, give the same."""
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 2)
    df = spark.createDataFrame(_docs(texts.items()), DOC)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, 4, 80).collect()}
    assert got == brute.near(texts, 4, 80)


def test_minhash_repeated_and_empty(spark):
    rows = [(1, "a b c d e f"), (1, "q r s t u v"), (2, "q r s t u v"), (3, "a b c d e f"), (3, "a b c d e f")]
    got = sorted((r.doc_id, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(_docs(rows), DOC)).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (3, 1)]
    assert minhash.near_duplicates(spark.createDataFrame([], DOC)).count() == 0


def test_minhash_common_phrase():
    """Short sets that share one hash and little else don't come into one bucket; those that are near do."""
    rng = np.random.default_rng(5)
    own = lambda n: rng.integers(1, 1 << 63, n, np.uint64)
    sets = [np.unique(np.append(own(20), np.uint64(12345))) for _ in range(3000)]
    near = np.unique(own(20))
    sets += [near, near[1:], np.unique(own(minhash.SHORT + 1)), np.zeros(0, np.uint64), np.unique(own(minhash.SHORT * 2))]
    regs, keys = minhash.registers(sets), minhash.short_keys(sets, 80)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sets))), pa.array([len(x) for x in sets]), pa.array([r.tobytes() for r in regs], pa.binary()), pa.array(keys, pa.binary())], ["rep", "n", "regs", "keys"])
    bands = [(b, r) for t in minhash._bands(iter([batch])) for b, r in zip(t["band"].to_pylist(), t["rep"].to_pylist(), strict=True)]
    assert max(Counter(b for b, _ in bands).values()) < 10
    of = lambda i: {b for b, r in bands if r == i}
    assert of(3000) & of(3001) and len(of(3002)) > 32 and not of(3003) and not keys[3003] and not keys[3004] and of(3004)


def test_registers_estimate():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 4000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:3500], rng.integers(0, 2**63, 400, dtype=np.uint64)]))
    r = minhash.registers([a, b])
    guess, filled = minhash.estimate(r[0], r[1:], len(a), np.array([len(b)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert filled[0] == 128 and abs(guess[0] - true) < 0.15


def test_components_with_more(spark):
    """Further links join components that are known, and bring ids of their own."""
    rng = random.Random(3)
    one = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)]
    two = [(rng.randrange(260), rng.randrange(260)) for _ in range(50)]
    frame = lambda rows: spark.createDataFrame(rows, "a bigint, b bigint")
    got = {r.id: r.root for r in components.with_more(components.components(frame(one)), frame(two)).collect()}
    want = {r.id: r.root for r in components.components(frame(one + two)).collect()}
    assert got == want


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000), (None, 4)]
    got = {r.id: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    up: dict[int, int] = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    assert got == {x: root(x) for x in up}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def _vectors():
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for label in (0, 1, 2):
        for _ in range(25):
            c = rng.normal(size=16)
            for noise in (0, 0, 0.03, 0.05, 0.06):
                rows.append((k, [float(x) for x in (c + noise * rng.normal(size=16)) * rng.uniform(0.5, 2)], label))
                k += 1
    rows += [(k, None, 0), (k + 1, [0.0] * 16, 0), (k + 2, [float("nan")] + [1.0] * 15, 0), (k + 3, [None] + [1.0] * 15, 0), (k + 4, rows[0][1], None), (k + 5, rows[0][1][:8], 0), (k + 6, [], 1), (k + 7, [1e200] * 16, 2), (k + 8, [1e-200] * 16, 2)]
    return rows


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_embeddings_have_cells(spark, sf):
    """Spherical k-means divides every given table: several cells of a label hold vectors."""
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    cells = embeddings._fitted(rows.where("label is not null and embedding is not null"), 0.98)
    assert len(cells.centroids) >= 2
    shared = spark.sparkContext.broadcast(cells)
    placed = rows.select("vec_id", F.col("label").cast("bigint").alias("label"), "embedding").mapInArrow(embeddings._place(shared), "vec_id bigint, label bigint, dim int, cell int, digest binary")
    assert placed.where("cell is not null and label is not null").groupBy("label").agg(F.countDistinct("cell").alias("n")).agg(F.max("n")).first()[0] >= 2


def test_embeddings_of_named_labels(spark):
    """Labels may be words, dates or fractions; the result is that of numbers."""
    rows = _vectors()
    name = {0: "zero", 1: "one", 2: "a much longer name", None: None}
    named = spark.createDataFrame([(i, v, name[lab]) for i, v, lab in rows], "vec_id bigint, embedding array<double>, label string")
    plain = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    take = lambda df: sorted(tuple(r) for r in embeddings.near_duplicates(df).collect())
    assert take(named) == take(plain)


@pytest.mark.parametrize(("cell_rows", "block"), [(2500, 4096), (20, 16)])
def test_embeddings(spark, monkeypatch, cell_rows, block):
    """Cells by the root of a label's vectors, or smaller ones still."""
    monkeypatch.setattr(embeddings, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", block)
    rows = _vectors()
    df = spark.createDataFrame([(i, v, lab, 1, "x") for i, v, lab in rows], "vec_id bigint, embedding array<double>, label int, copies int, unit string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()}

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v) / max(map(abs, v))
        return x / np.linalg.norm(x)

    u = {i: unit(v) for i, v, _ in rows}
    lab = {i: x for i, _, x in rows}

    def linked(a, b):
        return lab[a] is not None and lab[a] == lab[b] and u[a] is not None and u[b] is not None and len(u[a]) == len(u[b]) and float(u[a] @ u[b]) >= 0.98

    comp = brute.components(sorted(u), linked)
    for i in u:
        n = sum(linked(i, j) for j in u if j != i)
        assert got[i] == (n, comp[i], comp[i] == i)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_repeated_ids(spark):
    """Each row of an id counts as a vector; the id's component is that of all its rows."""
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (4, [1.0, 0.02]), (4, [1.0, 0.02]), (9, [-1.0, 0.3])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect())
    unit = [np.array(v) / np.linalg.norm(v) for _, v in rows]
    want = sorted((i, sum(float(unit[a] @ u) >= 0.98 for b, u in enumerate(unit) if b != a), 9 if i == 9 else 1, i in (1, 9)) for a, (i, _) in enumerate(rows))
    assert got == want


def test_embeddings_in_many_cells(spark, monkeypatch):
    """Linked pairs across cells' borders are found, whatever the cells; few vectors travel as guests."""
    monkeypatch.setattr(embeddings, "CELL_ROWS", 15)
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 8)
    monkeypatch.setattr(embeddings, "REMEMBERED", 3)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 6))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[200:] = x[:100] + 0.04 * rng.normal(size=(100, 6))
    x[150:190] = x[150]
    rows = [(i, [float(c) for c in v], i % 2 if i < 200 else (i - 200) % 2) for i, v in enumerate(x)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    hit = (u @ u.T >= 0.98) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows])[None, :])
    comp = brute.components(list(range(300)), lambda a, b: bool(hit[a, b]))
    assert got == {i: (int(hit[i].sum()) - 1, comp[i]) for i in range(300)}


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(_words(rng, rng.choice([1, 5, 50, 400]))), rng.choice(["a", "b", "c", "d", None, "é"])) for i in range(400)]
    rows += [(None, "one two", "a"), (400, None, "b"), (401, " ", "only-blanks"), (402, "w " * 20_000, "z"), (5, rows[5][1], rows[5][2])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, source string, size int, rank string")
    per, blocks = mixing.mix(df, block=64)
    got = per.collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.WORD.findall(t or ""))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, target = set(names), {}
    while True:
        share = (sum(sizes.values()) - sum(target.values())) / sum(weight[s] for s in left)
        full = {s for s in left if share * weight[s] > 3 * sizes[s]}
        if not full:
            break
        target |= {s: 3.0 * sizes[s] for s in full}
        left -= full
    target |= {s: share * weight[s] for s in left}
    source = {(i, len(brute.WORD.findall(t or ""))): s for i, t, s in rows}
    taken: dict = {}
    for r in got:
        s = source[(r.doc_id, r.size)]
        assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        assert 0 <= r.taken <= 3 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    assert {s: round(t) for s, t in target.items()} == taken
    again = mixing.mix(df, block=64)[0].collect()
    assert sorted(str(r[1:]) for r in again) == sorted(str(r[1:]) for r in got)
    # Blocks are full but for their source's last one, and the schedule spreads the sources.
    per_block = blocks.groupBy("sid", "rank").agg(F.sum("n_words").alias("n"), F.max("slot").alias("slot")).collect()
    last = {}
    for r in per_block:
        last[r.sid] = max(last.get(r.sid, 0), r["rank"])
    assert all(r.n == 64 for r in per_block if r["rank"] < last[r.sid])
    slots = sorted(r.slot for r in per_block)
    assert slots == list(range(len(per_block)))
    # Of any first slots, each source has its share but for a few.
    n = {s: sum(1 for r in per_block if r.sid == s) for s in last}
    for s in n:
        mine = sorted(r.slot for r in per_block if r.sid == s)
        assert all(abs(k + 1 - (slot + 1) * n[s] / len(slots)) < 5 for k, slot in enumerate(mine))
        ranks = [r["rank"] for r in sorted((r for r in per_block if r.sid == s), key=lambda r: r.slot)]
        assert sum(a > b for a, b in zip(ranks, ranks[1:])) <= 2
    first = {r.row: (r.first, r.n) for r in blocks.groupBy("row").agg(F.min("slot").alias("first"), F.countDistinct("rank").alias("n")).collect()}
    assert all((r.first_slot, r.n_blocks) == first.get(r.row, (None, 0)) for r in got) and any(r.n_blocks > 1 for r in got)
    assert mixing.mix(df.limit(0))[0].count() == 0


@pytest.mark.parametrize("long", [4096, 2])
def test_chat_windows(spark, monkeypatch, long):
    """Windows against a walk over each conversation: gaps in turns, thousands of turns, null and equal ones, system turns alone and before long turns; the same whether a conversation lies in one task or in ranges of its turns."""
    monkeypatch.setattr(chat, "LONG", long)
    rng = random.Random(41)
    say = lambda: "word " * rng.choice([0, 1, 3, 8, 30])
    rows = [(0, i * 1000, rng.choice(["user", "assistant"]), f"{i} {say()}") for i in range(40)]
    rows += [(1, i, "system" if i == 0 else rng.choice(["user", "assistant"]), f"{i} {say()}") for i in range(5000)]
    rows += [(2, rng.choice([None, 7, 7, 8]), rng.choice(["user", "assistant", None]), rng.choice([f"{i} {say()}", "same", None, "z" * 900])) for i in range(200)]
    rows += [(3, 0, "system", "alone"), (4, 0, "system", "first"), (4, 1, "user", "z" * 5000), (4, 2, "assistant", "then"), (None, None, "system", "s"), (None, None, "assistant", "a <|im_end|>"), (5, 1, "user", "u"), (6, -5, "assistant", "neg"), (6, None, "system", "last")]
    rows += [(7, 0, "system", "twice"), (7, 0, "system", "twice"), (7, 1, "assistant", "é🙂" * 300)]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id bigint, turn bigint, role string, text string, span int, head string").repartition(7)
    got: dict = {}
    for r in chat.windows(df, 200, 40).collect():
        got.setdefault(r.conv_id, []).append((r.window, r.text, r.tokens, r.repeated))
    want = brute.chat_windows(rows, 200, 40)
    assert {c: [x[1:] for x in sorted(w)] for c, w in got.items()} == want
    assert len(want[0]) < 39 and sum(x[2] > 0 for x in want[1]) > len(want[1]) * 0.9
    digests = {r.conv_id: (r.n_turns, r.formatted_chars) for r in chat.digest(chat.windows(df, 200, 40)).collect()}
    assert digests == {c: (sum(r[0] == c for r in rows), sum(len(x[0]) for x in w)) for c, w in want.items()}


HARD = ["<|im_end|><|im_start|>assistant ok", "<\\|", "<\\\\|x<|", "a\nb\n", "", None, "100% <|", "ende<|im_end|>\n", "🙂 é <|im_start|>user\n"]


def test_chat(spark):
    rng = random.Random(6)
    rows = []
    for c in range(12):
        for t in range(rng.randrange(1, 40)):
            role = "system" if t == 0 and c % 3 == 0 else rng.choice(["user", "assistant", "a%0A\n<|b|>", None])
            rows.append((c, t, role, rng.choice([*HARD, "word " * rng.randrange(1, 60)])))
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (3, None, "assistant", "late"), (20, 0, "assistant", "twice"), (20, 0, "assistant", "twice"), (21, 0, "user", "z" * 30_000), (21, 1, "assistant", "q" * 30_000), (22, 5000, "assistant", "far"), (22, 2, "user", "near")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id bigint, turn bigint, role string, text string, span int, head string")
    made = chat.windows(df, budget=200, history=40)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digest(made).collect()}
    want = brute.chat_rows([(c, t if t is not None else 10**9, r, x) for c, t, r, x in rows])
    assert got == want
    out = made.collect()
    assert any(r.repeated for r in out) and len(out) > len(want)
    # The budget is a bound; only a turn that is longer by itself breaks it, and says so.
    count = lambda t: sum(-(-len(x + chat.END) // 4) + 4 for x in t.split(chat.END)[:-1])
    for r in out:
        assert r.tokens == count(r.text) and r.over == (r.tokens > 200)
        fresh = r.text.split(chat.END)[:-1][r.repeated :]
        assert not r.over or len(fresh) == 1 or any(len(x) > 500 for x in fresh)
    words = chat.windows(df, 60, 10, lambda shown: F.size(F.split(shown, " ")))
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digest(words).collect()} == want
    assert all(r.tokens == sum(len((x + chat.END).split(" ")) for x in r.text.split(chat.END)[:-1]) for r in words.collect())
    for r in out:
        system = any(c == r.conv_id and t == 0 and role == "system" for c, t, role, _ in rows)
        assert not system or r.text.startswith("<|im_start|>system\n")
    assert chat.digest(chat.windows(df.limit(0))).count() == 0


NASTY = [
    None, "", "a@b.c_d@e.f x@y", "mail a.b+c@d-e.co.uk, 1.2.3.4.5.6.7.8 and 256.1.1.1 0255.1.1.1 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111", "+1 (632) 555-4827 +12 +123456789012345 +1234567890123456",
    "é🙂 x@y.z 🙂 10.0.0.1", "1" * 40_000, "a" * 60_000 + "@", "a." * 30_000, "+" + "(" * 30_000, "1 " * 30_000, "@" * 1000, "x@y.z@w.v", "...@..a.b", "1.1.1.1.1", "+1.2.3.4 5678901", "00000000000000 4222222222222220000",
]


def test_pii(spark):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(NASTY)], "doc_id bigint, text string, base int, spans string")
    for r in pii.digest(pii.sanitise(df)).collect():
        spans = brute.personal(NASTY[r.doc_id])
        assert r.base_sha256 == brute.personal_sha(NASTY[r.doc_id]), r.doc_id
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in spans) for k in brute.KINDS]
    assert pii.sanitise(df.limit(0)).count() == 0


def test_pii_many_spans(spark):
    """More spans than a chunk holds, some of them over one another, and terms between them."""
    numbers = "+4111 1111 1111 1111 é "
    texts = ["".join(f"🙂 u{i}@x.org vexillum {numbers if i % 3 == 0 else ''}" for i in range(n)) + "end" for n in (1, 256, 257, 700)]
    got = {r.doc_id: r for r in pii.sanitise(spark.createDataFrame([*enumerate(texts), *((9 + i, "plain words") for i in range(40))], "doc_id bigint, text string")).collect()}
    for i, text in enumerate(texts):
        out, at = [], 0
        for s in got[i].spans:
            assert text[s.start : s.end] == s.value
            if s.start >= at:
                out += [text[at : s.start], pii.MARKS.get(s.kind, "")]
                at = s.end
        assert [s.kind for s in got[i].spans].count("email") == text.count("@")
        assert any(s.kind == "term" and s.value == "vexillum" for s in got[i].spans)
        clean = re.sub(r"\[(WORD|NUMBER)\]", "", got[i].clean)
        assert clean == "".join(out) + text[at:]


def test_pii_terms(spark):
    """A word that occurs near one entity only gives it away; a frequent one doesn't, and texts without entities stay."""
    rows = [(i, f"the clerk zanzibar wrote to bob@corp.example about the {i}th case") for i in range(6)]
    rows += [(10 + i, f"the case number {i} went to the clerk and about nothing") for i in range(60)]
    rows += [(100, "zanzibar alone")]
    got = {r.doc_id: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    # zanzibar occurs once elsewhere (0.94 of the entity's information), wrote nowhere else.
    assert got[0].clean == "the clerk [WORD]  to [EMAIL] about the 0th case"
    assert [s.kind for s in got[0].spans].count("email") == 1
    terms = {s.value for s in got[0].spans if s.kind == "term"}
    assert "zanzibar" in terms and "the" not in terms and "clerk" not in terms
    assert all(not got[i].spans and got[i].clean == dict(rows)[i] for i in range(10, 70)) and got[100].clean == "zanzibar alone"


def test_pii_terms_of_rare_entities(spark):
    """Terms of entities in one or two documents are judged: a name beside one address gives it away, and so do names that stand with it once each."""
    rows = [(0, "ask zebulon about it at zeb@corp.example please"), (1, "call quentin now at 10.1.2.3 about it"), (2, "call rosalind now at 10.1.2.3 about it")]
    rows += [(10 + i, f"please call now and ask about it at case number {i}") for i in range(300)]
    got = {r.doc_id: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0].clean == "ask  about it at [EMAIL] please"
    # 10.1.2.3 is in two documents, each name in one: log2(303 / 2) of log2(303).
    assert got[1].clean == "call [WORD] now at [IP] about it" and got[2].clean == "call [WORD] now at [IP] about it"
    assert [(s.kind, s.value) for s in got[1].spans] == [("term", "quentin"), ("ip", "10.1.2.3")]
    assert all(got[i].clean == t for i, t in rows[3:])


def test_pii_terms_against_counting(spark, monkeypatch):
    """Spans of all kinds, terms among them, from the same rule by counting every pair in plain Python."""
    rng = random.Random(32)
    mails = [f"p{k}@corp.example" for k in range(6)]
    texts: list[str | None] = [None, "", "a@b.example", "Zoë-Maria" * 3000 + " x@y.example " + "né " * 2000]
    for k in range(150):
        w = _words(rng, rng.randrange(1, 60), 60 if k % 2 else 2000)
        for _ in range(rng.choice([0, 0, 1, 2])):
            m = rng.randrange(6)
            w[rng.randrange(len(w)) :][:1] = []
            w.insert(rng.randrange(len(w) + 1), rng.choice([f"name{m}, {mails[m]}", mails[m], f"({mails[m]}) \n NAME{m}:", "+1 (632) 555-4827 10.0.0.1"]))
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = brute.sanitised(texts)
    assert sum(s[2] == "term" for x in want for s in x[0]) > 30
    for chunk in (256, 3):
        monkeypatch.setattr(pii, "CHUNK", chunk)
        rows = pii.sanitise(df)
        got = {r.doc_id: (r.spans, r.n_generalised, r.n_removed) for r in pii.digest(rows).collect()}
        assert got == {i: (",".join(f"{k}:{a}:{z}" for a, _, k, z in x), n, gone) for i, (x, n, gone, _) in enumerate(want)}
        assert {r.doc_id: r.clean for r in rows.collect()} == {i: x[3] for i, x in enumerate(want)}


def test_pii_is_linear_in_entities(spark):
    """Thousands of addresses in one text, a line each, and thousands of terms that give them away: seconds, not minutes."""
    import time

    text = "\n".join(f"name{i} u{i}@x.example" for i in range(6000))
    df = spark.createDataFrame([(0, text), *((1 + i, "plain words") for i in range(50))], "doc_id bigint, text string")
    began = time.time()
    r = pii.digest(pii.sanitise(df)).where("doc_id = 0").first()
    assert (r.n_email, r.n_generalised + r.n_removed) == (6000, 6000) and time.time() - began < 60


@pytest.mark.parametrize("name", ["op3_mix_sources", "op5_chat_format", "op6_pii", "op12_quality_rules"])
def test_native(name, spark, sf_dir, monkeypatch):
    """Nothing on the main path of a native operator runs Python, pandas, Arrow or RDD code: neither what it returns nor any table that it writes on the way."""
    from relweave.llm import common

    plans = []
    monkeypatch.setattr(chat, "LONG", 3)
    for module in (chat, mixing, pii, rules):
        monkeypatch.setattr(module, "stored", lambda df, what: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), common.stored(df, what))[1])
    plans.append(QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString())
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", "".join(plans)) and len(plans) > 2


def test_pii_frequent_entity(spark):
    """An entity in 9 of 10 documents, with many terms of its own: each document gets the terms that it holds, and no task all of them."""
    rows = [(i, f"write to all@corp.example or w{i} and v{i}" if i % 10 else f"nothing {i}") for i in range(600)]
    out = pii.sanitise(spark.createDataFrame(rows, "doc_id bigint, text string"), generalise=-5.0)
    got = {r.doc_id: {s.value for s in r.spans if s.kind == "term"} for r in out.collect()}
    assert all(got[i] <= set(t.split()) for i, t in rows) and {"w11", "v11"} <= got[11] and not got[10]


def test_located_in_groups(spark, monkeypatch):
    """Places are the same whatever the groups that matches are summed in; tens of thousands of matches in a text are no matter."""
    monkeypatch.setattr(pii, "CHUNK", 3)
    texts = ["", "a1b22c333d", "1 " * 50, "é9🙂8"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [[(m.start, m.end, m.value) for m in r[0]] for r in df.select(pii.located(F.col("text"), "[0-9]+")).collect()]
    import re

    assert got == [[(m.start(), m.end(), m.group()) for m in re.finditer("[0-9]+", t)] for t in texts]
    monkeypatch.setattr(pii, "CHUNK", 256)
    many = spark.createDataFrame([(" ".join(f"u{i}@x.example" for i in range(40_000)),)], "text string")
    assert many.select(F.size(pii.located(F.col("text"), pii.PATTERNS["email"]))).first()[0] == 40_000


def test_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(8)
    rows = [(i, t) for i, t in enumerate(["", "Hello  world", "a b c\x1cd\re", "é é ﬁ", "x<|endoftext|>y z", "don't we'll\n\n\tgo", "İstanbul Σς", " ́lone", "1234 ½ ①", "w " * 30_000, "🙂🙂"])]
    rows += [(50 + i, " ".join(_words(rng, 200))) for i in range(40)]
    rows += [(7, "again"), (7, "again"), (-3, "before")]
    df = spark.createDataFrame([(*r, "x") for r in [*rows, (200, None)]], "doc_id bigint, text string, content string")
    path = f"file://{tmp_path}/tok"
    got = sorted(tuple(r) for r in tokens.written(df, tokenizer_path(), 1, path).collect())
    assert got == sorted(brute.token_rows([*rows, (200, "")], Tokenizer.from_file(tokenizer_path())))
    some = sorted(tuple(r) for r in tokens.read(spark, path, [7, 55, 200, 10**6]).collect())
    assert some == [r for r in got if r[0] in (7, 55, 200)] and len(some) == 5
    f = next(p for p in (tmp_path / "tok").iterdir() if p.name.startswith("part-"))
    data = f.read_bytes()
    reads: list[int] = []

    def read_at(at, n):
        reads.append(n)
        return data[at : at + n]

    file = tokens.TokenFile(len(data), read_at)
    name = file.frames[0][4][0][1]
    assert [i for i, _ in file.documents({int(name)})].count(int(name)) >= 1
    assert zstandard.ZstdDecompressor().stream_reader(BytesIO(data), read_across_frames=True).read(4)  # any reader takes the file
    broken = bytearray(data)
    broken[3] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(tokens.TokenFile(len(broken), lambda at, n: bytes(broken[at : at + n])).documents())
    empty = tokens.written(df.limit(0), tokenizer_path(), 1, f"file://{tmp_path}/none")
    assert empty.count() == 0


def test_token_frames(monkeypatch):
    """Only frames that hold what is wanted are read."""
    monkeypatch.setattr(tokens, "FRAME_IDS", 10)
    b = tokens.FileBuilder()
    for i in range(20):
        b.add(i, np.full(6, i, np.uint32))
    b.add(None, np.zeros(0, np.uint32))
    data = b.finish(3) + tokens.TAIL.encode("latin-1")
    reads: list[tuple[int, int]] = []

    def read_at(at, n):
        reads.append((at, n))
        return data[at : at + n]

    f = tokens.TokenFile(len(data), read_at)
    reads.clear()
    assert [(i, x.tolist()) for i, x in f.documents({5})] == [(5, [5] * 6)]
    assert len(reads) == 1 and f.order == 3
    assert [i for i, _ in f.documents()] == [*range(20), None]
    with pytest.raises(ValueError, match="footer"):
        tokens.TokenFile(len(data) - 1, lambda at, n: data[at : at + n])


PAGES = [(3, "u3", "<p>same</p>"), (1, "u1", "<p>same</p>"), (2, "u2", "<p>other é</p>"), (4, None, None), (5, "u\r\n5", ""), (6, "u6", "x" * 200_000), (7, "u7", "<p>same</p>"), (1, "u1", "<p>same</p>"), (None, "n", "<p>null id</p>")]


def test_warc(spark, tmp_path):
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id bigint, url string, html string, digest string")
    path = f"file://{tmp_path}/warc"
    got = sorted((tuple(r) for r in warc.written(df, 0, path).collect()), key=str)
    first = {"<p>same</p>": 1, "": 4}
    want = []
    seen: set = set()
    for p, _, h in PAGES:
        h = h or ""
        base = brute.warc_rows([(0, h)])[0]
        own = first.get(h, p) == p and (h not in first or h not in seen)
        seen |= {h} if own else set()
        want.append((p, base[1], base[2], "response" if own else "revisit", None if own else first[h]))
    assert got == sorted(want, key=str)
    assert sorted(map(str, (tuple(r) for r in warc.read(spark, path, [1, 6]).collect()))) == sorted(str(r) for r in got if r[0] in (1, 6))
    # From 5 bytes on: the two empty payloads are both responses.
    assert sum(r.record_type == "response" for r in warc.written(df, 5, f"file://{tmp_path}/warc5").collect()) == 6
    for f in (tmp_path / "warc").iterdir():
        if f.name.startswith("part-"):
            with zipfile.ZipFile(f) as z:  # an independent reader agrees
                assert z.testzip() is None and warc.ARCHIVE in z.namelist()
            data = f.read_bytes()
            reads: list[int] = []

            def read_at(at, n, data=data, reads=reads):
                reads.append(n)
                return data[at : at + n]

            p = warc.Package(len(data), read_at)
            one = p.index()[0]
            reads.clear()
            head, _ = next(p.records(lambda e, one=one: e == one))
            assert head["warc-type"] in ("response", "revisit") and sum(reads) < len(data) + 100
    assert warc.written(df.limit(0), 0, f"file://{tmp_path}/none").count() == 0


def test_warc_hot_payload(spark, tmp_path, monkeypatch):
    """A payload that most pages share is sent on once or few times a task, and its revisits bear none."""
    rng = random.Random(2)
    ids = rng.sample(range(4000), 900)
    rows = [(i, f"u{i}", "<p>empty page</p>" * 50 if k % 10 else f"<p>{i}</p>") for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    parts = warc._members(0)
    sent = df.mapInArrow(parts, "page_id bigint, url string, hex string, bytes bigint, member binary").groupBy("hex").count()
    assert sent.agg(F.max("count")).first()[0] < 60
    got = sorted(tuple(r) for r in warc.written(df, 0, f"file://{tmp_path}/hot").collect())
    assert got == sorted(brute.warc_rows([(i, h) for i, _, h in rows]))


@pytest.mark.parametrize("zip64", [True, False])
def test_zip_reader(zip64):
    members = [("archive/a.warc.gz", warc.record("response", 1, "u", "D", 2, b"hi")), ("indexes/i.cdxj", b""), ("x/ü.txt", b"PK\x05\x06 inside" * 3)]
    data = warc.package(members, zip64) + b"\n"
    p = warc.Package(len(data), lambda at, n: data[at : at + n])
    assert {n: p.range(n) for n in p.members} == dict(members)
    assert p.range("x/ü.txt", 3, 4) == members[2][1][3:7]
    assert warc.parse_record(p.range("archive/a.warc.gz"))[1] == b"hi"
    with pytest.raises(ValueError):
        warc.Package(10, lambda at, n: b"0123456789"[at : at + n])
    buf = BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("s.txt", b"stored")
        z.writestr("d.txt", b"deflated" * 50, zipfile.ZIP_DEFLATED)
    data2 = buf.getvalue()
    q = warc.Package(len(data2), lambda at, n: data2[at : at + n])
    assert q.range("s.txt") == b"stored"
    with pytest.raises(ValueError, match="compressed"):
        q.range("d.txt")


def _items(rng):
    items = [(i, " ".join(_words(rng, n, 5000)).capitalize() + ". " + " ".join(_words(rng, 8, 5000)) + ".") for i, n in enumerate([12, 20, 40, 80, 300, 15])]
    return [*items, (10, None), (11, ""), (12, "..."), (13, "Who is it? Answer: nobody at all here now"), (14, items[0][1]), (None, " ".join(_words(rng, 25, 5000)))]


def test_decontamination(spark):
    rng = random.Random(9)
    items = _items(rng)
    clean = [(i, " ".join(_words(rng, rng.randrange(1, 600), 5000))) for i in range(40)]
    leaks = [(100 + k, " ".join(_words(rng, 300, 5000)) + " " + t.upper().replace(" ", ",  ") + " " + " ".join(_words(rng, 200, 5000))) for k, (_, t) in enumerate(items) if t and len(t) > 3]
    near_ = items[3][1].split()
    near_[30] = "changed"
    rows = [*clean, *leaks, (200, " ".join(near_)), (201, None), (202, ""), (203, " ".join(items[3][1].split()[:20])), (None, items[1][1]), (204, items[2][1]), (204, items[2][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, score int")
    it = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted(((r.doc_id, r.item_id, r.kind) for r in decontam.contaminated(df, it).collect()), key=str)
    want = [(d, i, kind) for d, t in rows for i, x in items if (kind := brute.holds_item(t, x, decontam.question_and_answer(x or "")))]
    assert got == sorted(want, key=str)
    bad = {d for d, _, _ in want}
    kept = decontam.cleaned(df, it).collect()
    assert len(kept) == sum(1 for d, t in rows if d not in bad) and all(r.doc_id not in bad for r in kept)
    assert decontam.contaminated(df.limit(0), it).count() == 0 and decontam.contaminated(df, it.limit(0)).count() == 0


def test_questions_without_answers_are_found(spark):
    """A question is held without its answer, however much of the item's weight the answer has."""
    rng = random.Random(21)
    asked = [" ".join(_words(rng, n, 5000)) + "?" for n in (5, 8, 12, 30)]
    items = [(i, f"{q} Answer: {' '.join(_words(rng, 60, 5000))}") for i, q in enumerate(asked)]
    rows = [(i, f"{' '.join(_words(rng, 400, 5000))} {q} {' '.join(_words(rng, 300, 5000))}") for i, q in enumerate(asked)]
    rows += [(10, " ".join(asked)), (11, asked[0]), (12, " ".join(asked[2].split()[:8]))]
    df, it = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = decontam.contaminated(df, it).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [*((i, i) for i in range(4)), *((10, i) for i in range(4)), (11, 0)]
    assert all(r.question_overlap == 1 and r.answer_overlap < 0.1 and 0 < r.score < 0.6 for r in got if r.doc_id < 4)
    assert [r.doc_id for r in decontam.cleaned(df, it).collect()] == [12]


def test_recall_over_shapes(spark):
    """Questions and answers of 5 to 100 words, whole, apart, cut, or alone in long documents: all that the rule accepts is reported, and nothing else."""
    rng = random.Random(23)
    shapes = [(q, a) for q in (5, 6, 10, 24, 60, 100) for a in (1, 3, 5, 8, 20, 40, 100)]
    items = [(i, " ".join(_words(rng, q, 9000)) + "? " + " ".join(_words(rng, a, 9000))) for i, (q, a) in enumerate(shapes)]
    filler = lambda n: " ".join(_words(rng, n, 9000))
    rows = []
    for i, t in items:
        q, a = decontam.question_and_answer(t)
        w, v = q.split(), a.split()
        shown = [q, a, f"{q} {filler(400)} {a}", f"{a} {filler(90)} {q}", " ".join(w[: len(w) * 2 // 3]) + f" {filler(30)} {a}", " ".join(w[: len(w) // 3]) + " " + a, " ".join([*w[:-1], "changed", *v]), t.upper()]
        rows += [(len(shown) * i + k, f"{filler(rng.randrange(0, 700))} {x} {filler(rng.randrange(0, 700))}") for k, x in enumerate(shown)]
    want = {(d, i, kind) for d, t in rows for i, x in items if (kind := brute.holds_item(t, x, decontam.question_and_answer(x)))}
    assert {k for _, _, k in want} == {"question and answer", "question", "answer", "whole"}
    df, it = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert {(r.doc_id, r.item_id, r.kind) for r in decontam.contaminated(df, it).collect()} == want


def test_many_items_read_the_corpus_once(spark):
    rng = random.Random(24)
    items = [(i, " ".join(_words(rng, 30, 50_000))) for i in range(5000)]
    rows = [(i, " ".join(_words(rng, 60, 50_000)) + " " + items[i * 37 % 5000][1]) for i in range(60)] + [(99, " ".join(_words(rng, 90_000, 50_000)) + " " + items[7][1]), (100, "x" * 300_000)]
    found = decontam.contaminated(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [*((i, i * 37 % 5000) for i in range(60)), (99, 7)]


def test_parts_that_stand_apart_are_found(monkeypatch):
    """An item is held if its runs are anywhere in the document, with any number of words between its parts; and only what the index retrieves is held."""
    monkeypatch.setattr(decontam, "CELLS_AT_ONCE", 3)
    rng = random.Random(22)
    items = [(i, _words(rng, n, 5000)) for i, n in enumerate([50, 60, 100, 300, 3])]
    texts = ["", "one"]
    for _, w in items:
        for cuts in (1, 2):
            gap = [_words(rng, 900, 5000) for _ in range(cuts)]
            at = [len(w) * k // (cuts + 1) for k in range(cuts + 2)]
            texts.append(" ".join(x for k in range(cuts + 1) for x in [*w[at[k] : at[k + 1]], *(gap[k] if k < cuts else [])]))
    texts.append(" ".join(w for _, x in items for w in x))
    df = np.zeros(decontam.DF_PLACES, np.int32)
    index = decontam.build([(i, " ".join(w)) for i, w in items], df, len(items), 100.0)
    got = {(d, i): (score, overlap) for d, i, score, overlap, *_ in decontam.verified(index, pa.array(texts))}
    own = [{tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in map(str.split, texts)]
    want = set()
    for d, t in enumerate(texts):
        for i, w in items:
            r = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
            if (len(r & own[d]) >= 0.8 * len(r)) if r else f" {' '.join(w)} " in f" {t} ":
                want.add((d, i))
    assert got.keys() == want and {(2 + 2 * i + c, i) for i in range(4) for c in (0, 1)} <= want
    assert sum(score < 0.6 for score, _ in got.values()) >= 6
    monkeypatch.setattr(decontam, "retrieve", lambda *_: [])
    assert decontam.verified(index, pa.array(texts)) == []


def _index(texts):
    df = np.zeros(decontam.DF_PLACES, np.int32)
    words, at = decontam.term_hashes(pa.array(texts, pa.large_string()))
    for a, b in zip(at[:-1], at[1:], strict=True):
        df[np.unique((words[a:b] % np.uint64(decontam.DF_PLACES)).astype(np.int64))] += 1
    return lambda items: decontam.build(items, df, len(texts), len(words) / len(texts))


def test_retrieval_is_whole():
    """Block-max bounds leave out nothing that reaches an entry's least score, however items are divided among indexes."""
    rng = random.Random(10)
    items = [(i, " ".join(_words(rng, rng.randrange(4, 60), 120)) + rng.choice(["", "? " + " ".join(_words(rng, 8, 120))])) for i in range(90)]
    make = _index([t for _, t in items])
    whole = make(items)
    texts = [" ".join(_words(rng, rng.randrange(1, 400), 150)) for _ in range(30)] + [t for _, t in items[:20]]
    w, at = decontam.term_hashes(pa.array(texts, pa.large_string()))
    found = decontam.retrieve(whole, w, at)
    want = set()
    for d in range(len(texts)):
        score = np.zeros(len(whole.item))
        for t in np.unique(whole.lookup(w[at[d] : at[d + 1]])[1]):
            score[whole.entry[whole.ptr[t] : whole.ptr[t + 1]]] += whole.impact[whole.ptr[t] : whole.ptr[t + 1]]
        want |= {(d, int(i)) for i in whole.item[score >= 1]}
    assert set(found) == want and {(30 + k, k) for k in range(20)} <= want and len(want) < len(texts) * len(items) / 2
    parts = [make(items[a : a + 30]) for a in (0, 30, 60)]
    assert {(d, j + 30 * k) for k, x in enumerate(parts) for d, j in decontam.retrieve(x, w, at)} == want


def test_least_score_loses_nothing():
    """Recall of retrieval against a look at every run: whatever runs are taken out, and whatever terms go with them, a text with OVERLAP of an entry's runs is retrieved."""
    rng = random.Random(71)
    items = [(i, " ".join(_words(rng, rng.choice([2, 4, 5, 6, 9, 30, 80]), rng.choice([3, 20, 4000])))) for i in range(60)]
    index = _index([t for _, t in items])(items)
    texts, held = [], set()
    for i, t in items:
        w = t.split()
        for _ in range(12):
            cut = list(w)
            for _ in range(rng.randrange(0, 3)):
                k = rng.choice([0, len(cut) - 1, rng.randrange(len(cut))])
                cut[k : k + rng.randrange(1, 4)] = [f"x{rng.randrange(10**6)}"]
            texts.append(" ".join(cut))
    own = [brute.runs(t.split()) for t in texts]
    for d, t in enumerate(texts):
        for i, x in items:
            r = brute.runs(x.split())
            if sum(y in own[d] if len(y) == 5 else f" {' '.join(y)} " in f" {t} " for y in r) >= 0.8 * len(r):
                held.add((d, i))
    found = set(decontam.retrieve(index, *decontam.term_hashes(pa.array(texts, pa.large_string()))))
    assert held <= found and len(held) > 150


def test_language(spark):
    rng = random.Random(11)
    alphabets = {"aa": "abcde", "bb": "vwxyz", "cc": "äöüßñ"}
    word = lambda a: "".join(rng.choice(a) for _ in range(rng.randrange(2, 7)))
    rows = [(i, " ".join(word(alphabets[g]) for _ in range(30)), g) for i, g in enumerate(rng.choice(list(alphabets)) for _ in range(200))]
    rows += [(300, None, "aa"), (301, "", "aa"), (302, "12 !! 34", "bb"), (303, "vwx", None), (304, "🙂", "aa"), (305, "abc " * 40_000, "aa")]
    df = spark.createDataFrame([(*r, 0.1, "x") for r in rows], "doc_id bigint, text string, lang string, score double, lang_pred string")
    held = F.pmod("doc_id", F.lit(3)) == 1
    model = langid.fit(df, ~held)
    got = {r.doc_id: r for r in langid.identify(df, model, ["doc_id"]).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang_pred == g for i, _, g in rows[:200]) and got[303].lang_pred == "bb" and got[305].lang_pred == "aa"
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (300, 301, 302, 304))
    assert all(0 <= r.score <= 1 for r in got.values())
    # The same by counting n-grams in plain Python: its own n-grams and hash, all texts.
    want = brute.languages([(i, t, g) for i, t, g in rows if t is not None and g is not None and i % 3 != 1], {i: t for i, t, _ in rows}, langid.BUCKETS)
    for i, (lang, score) in want.items():
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-4, i
    none = langid.identify(df, langid.fit(df.where("lang = 'zz'")), ["doc_id"]).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert langid.identify(df.limit(0), model).count() == 0


def test_all_languages_are_learned(spark, monkeypatch):
    """Rare languages keep their rows when others are thinned, and languages beyond a block are scored too."""
    rng = random.Random(31)
    alphabets = {"aa": "abcde", "bb": "vwxyz", "cc": "klmno", "dd": "pqrst", "ee": "fghij"}
    word = lambda a: "".join(rng.choice(a) for _ in range(5))
    n = {"aa": 600, "bb": 300, "cc": 2, "dd": 1, "ee": 3}
    rows = [(i, " ".join(word(alphabets[g]) for _ in range(20)), g) for i, g in enumerate(g for g, k in n.items() for _ in range(k))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    whole = {r.doc_id: r for r in langid.identify(df, langid.fit(df), ["doc_id"]).collect()}
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    blocks = {r.doc_id: r for r in langid.identify(df, langid.fit(df), ["doc_id"]).collect()}
    assert all(blocks[i].lang_pred == whole[i].lang_pred == g and abs(blocks[i].score - whole[i].score) < 1e-9 for i, _, g in rows)
    thinned = {r.doc_id: r.lang_pred for r in langid.identify(df, langid.fit(df, train_docs=40, least=5), ["doc_id"]).collect()}
    assert all(thinned[i] == g for i, _, g in rows)
    assert langid.quota([600, 300, 2, 1, 3], 40, 5) == 17 and langid.quota([50] * 10, 40, 5) == 5


def test_languages_of_many_scripts(spark):
    """300 languages, and languages whose n-grams are of characters that take several bytes."""
    rng = random.Random(41)
    cjk = {"ja": "\u3042\u3044\u3046\u3048\u304a\u304b\u304d\u304f", "zh": "\u4e2d\u6587\u5b57\u7b26\u8bed\u8a00\u5b66\u4e60", "ko": "\ud55c\uad6d\uc5b4\uae00\uc790\ubb38\uc7a5\ub9d0"}
    rows = [(g, "".join(rng.choice(cjk[g]) for _ in range(40))) for g in cjk for _ in range(6)]
    latin = "abcdefghijklmnopqrstuvwxyz"
    for k in range(300):
        own = ["".join(rng.choice(latin) for _ in range(6)) for _ in range(8)]
        rows += [(f"l{k:03}", " ".join(rng.choice(own) for _ in range(12))) for _ in range(3)]
    df = spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(rows)], "doc_id bigint, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(df, langid.fit(df), ["doc_id"]).collect()}
    assert all(got[i] == g for i, (g, _) in enumerate(rows))


def test_gram_buckets_stay_in_their_texts(monkeypatch):
    texts = ["abcd", "", "é", "xyz", "ab", "Ü12 34", "中文字"]
    for piece in (1 << 18, 3, 1):
        monkeypatch.setattr(langid, "PIECE", piece)
        got = [(t, g) for x in langid.gram_buckets(pa.array(texts)) for t, g in zip(*(y.tolist() for y in x), strict=True)]
        assert got == [(k, g) for k, t in enumerate(texts) for g in brute.trigrams(t, langid.BUCKETS)]


def test_quality(spark):
    rng = random.Random(12)
    good = lambda: " ".join(_words(rng, 40, 3000))
    bad = lambda: " ".join(w + "***" for w in _words(rng, 40, 3000))
    rows = [(i, good() if i % 3 else bad()) for i in range(300)]
    docs = spark.createDataFrame([*((*r, 0.9, "x") for r in rows), (400, None, 0.0, ""), (401, "", 0.0, ""), (None, "w1 w2", 0.0, "")], "doc_id bigint, text string, score double, y string")
    labels = spark.createDataFrame([*((i, int(i % 3 > 0)) for i in range(300)), (1, 1), (7, None), (None, 0), (999, 0)], "doc_id bigint, quality int")
    w = quality.fit(docs, labels, train=F.pmod("doc_id", F.lit(4)) != 2)
    got = {r.doc_id: r for r in quality.score(docs, w, keep=["doc_id"]).collect()}
    held = [i for i in range(300) if i % 4 == 2]
    assert sum(got[i].predicted == int(i % 3 > 0) for i in held) >= 0.95 * len(held)
    assert len(got) == 303 and all(0 <= r.score <= 1 for r in got.values()) and got[400].score == got[401].score
    again = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels, train=F.pmod("doc_id", F.lit(4)) != 2), keep=["doc_id"]).collect()}
    assert again == {i: r.score for i, r in got.items()}
    assert (quality.fit(docs, labels.limit(0)) == 0).all() and quality.score(docs.limit(0), w).count() == 0


def _order(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    return [r.doc_id for r in rows.orderBy(F.xxhash64(F.col("doc_id"), F.lit(7)), "doc_id").collect()]


def test_registered_queries(spark, tmp_path):
    """The queries whose operators SQL can't express, through QUERIES, against plain Python: columns, held-out rows, scores and thresholds."""
    import zlib

    rng = random.Random(51)
    alphabets = {"en": "abcde", "xx": "vwxyz", "yy": "äöüéè"}
    docs = []
    # Few words, so that no two n-grams share a hash.
    pool = {g: ["".join(rng.choice(alphabets[g]) for _ in range(3)) for _ in range(5)] for g in alphabets}
    for i in range(160):
        g = rng.choice(list(alphabets))
        docs.append((i, " ".join(rng.choice(pool[g]) + ("!!" if i % 3 == 0 else "") for _ in range(25)), g if i % 11 else None, f"s{i % 3}"))
    docs += [(200, None, "en", "s0"), (201, "", "en", None), (202, "12 34", "xx", "s1"), (203, "abc " * 15_000, "en", "s1"), (204, "mail a@b.example now", "en", "s2")]
    docs += [(7, docs[7][1], docs[7][2], "s1")]
    spark.createDataFrame([(*d, len(d[1] or "")) for d in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, 160)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    item = docs[5][1] + ". A tail of six other words."
    spark.createDataFrame([(1, item), (2, "nothing of the kind stands in here at all")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    run = lambda name: QUERIES[name](spark, str(tmp_path))
    crc = lambda i, n: zlib.crc32(str(i).encode()) % n

    got = run("op10_language_id")
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    train = [(i, t, g) for i, t, g, _ in docs if t is not None and g is not None and crc(i, 3) != 1]
    want = brute.languages(train, {i: t for i, t, _, _ in docs}, langid.BUCKETS)
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (crc(r.doc_id, 3) == 1) and r.lang_pred == want[r.doc_id][0] and abs(r.score - want[r.doc_id][1]) < 1e-4

    got = run("op4_quality_classifier")
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    y = {i: q for i, q, _ in labels if crc(i, 4) != 2}
    text: dict = {}
    for i, t, _, _ in docs:
        text.setdefault(i, []).append(t)
    examples = [(brute.values(t), y[i]) for i in _order(spark, y) for t in text[i]]
    w = brute.ftrl(examples, quality.ALPHA, quality.BETA, quality.L1, quality.L2, quality.EPOCHS)
    for r in got.collect():
        dot = sum(w.get(k, 0.0) * v for k, v in brute.values(text[r.doc_id][0]).items())
        assert abs(r.score - 1 / (1 + np.exp(-dot))) < 1e-9 and r.held_out == (crc(r.doc_id, 4) == 2) and r.predicted == int(r.score >= 0.7)

    got = run("op6_pii")
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_generalised", "n_removed", "clean_sha256"]
    want = brute.sanitised([t for _, t, _, _ in docs])
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expect = sorted((d[0], sum(s[2] == "email" for s in x), brute.personal_sha(d[1]), ",".join(f"{k}:{a}:{z}" for a, _, k, z in x), n, gone, sha(clean)) for d, (x, n, gone, clean) in zip(docs, want, strict=True))
    assert sorted((r.doc_id, r.n_email, r.base_sha256, r.spans, r.n_generalised, r.n_removed, r.clean_sha256) for r in got.collect()) == expect and any(x[4] + x[5] for x in expect)

    got = run("op2_token_files")
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    from tokenizers import Tokenizer

    assert sorted(tuple(r) for r in got.collect()) == sorted(brute.token_rows([(i, t or "") for i, t, _, _ in docs], Tokenizer.from_file(tokenizer_path())))

    got = {(r.doc_id, r.item_id, r.kind) for r in run("op1_decontamination").collect()}
    assert got == {(i, n, k) for i, t, _, _ in docs for n, x in ((1, item), (2, "nothing of the kind stands in here at all")) if (k := brute.holds_item(t, x, decontam.question_and_answer(x)))} and got


def test_quality_threshold(spark):
    """A score at the threshold counts as reached; very long texts are scored like others."""
    w = np.zeros(quality.BUCKETS + 1)
    w[-1] = 0.5
    docs = spark.createDataFrame([(1, ""), (2, "word " * 100_000), (3, None)], "doc_id bigint, text string")
    at = 1 / (1 + np.exp(-0.5))
    assert [r.predicted for r in quality.score(docs, w, float(at)).orderBy("doc_id").collect()] == [1, 1, 1]
    assert [r.predicted for r in quality.score(docs, w, float(np.nextafter(at, 1))).orderBy("doc_id").collect()] == [0, 0, 0]


def test_ftrl_by_hand():
    """Two updates of one feature, worked out."""
    k, v = np.array([3], np.int32), np.array([1.0])
    w = quality.ftrl([(k, v, 1)], epochs=1)
    g = -0.5
    n = g * g
    z = g - (np.sqrt(n) / quality.ALPHA) * 0
    expect = -(z - np.sign(z) * quality.L1) / ((quality.BETA + np.sqrt(n)) / quality.ALPHA + quality.L2)
    assert abs(w[3] - expect) < 1e-12 and w[5] == 0


def test_registered(spark, sf_dir):
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(name, spark, sf_dir):
    same(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE_SQL[name])


def test_seek_table_layout():
    b = tokens.FileBuilder()
    b.add(9, np.array([1, 2, 3], np.uint32))
    data = b.finish(0)
    at = data.index(struct.pack("<I", tokens.TABLE_SKIPPABLE))
    assert struct.unpack_from("<I", data, at + 4)[0] == len(data) - at - 8
