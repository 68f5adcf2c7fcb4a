"""The pipeline's stages, each against plain Python on what it was given."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline as P
from relweave.llm.queries import tokenizer_path
from tests.llm import brute

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_stages(spark, tmp_path):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = {i: " ".join(word() for _ in range(rng.randrange(30, 120))) for i in range(60)}
    item = " ".join(word() for _ in range(30)) + "."
    texts |= {60: texts[3], 61: texts[4] + " " + word(), 62: "12 34 !!", 63: None, 64: " ".join(word() for _ in range(50)) + " " + item, 65: ""}
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in texts.items()], DOC)
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        path = f"{tmp_path}/{name}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = Counter(r.doc_id for r in docs.collect())
    language = set(texts) - {62, 63, 65}
    assert kept["language_id"] == Counter(language)
    near = brute.near({i: texts[i] for i in language}, 5, 80)
    assert kept["minhash_near_dedup"] == Counter(i for i in language if near[i][1] == i)
    assert 60 not in kept["minhash_near_dedup"] and 61 not in kept["minhash_near_dedup"]
    assert kept["decontamination"] == Counter(set(kept["minhash_near_dedup"]) - {64})
    want = brute.mixed([(i, texts[i], f"s{i % 4}") for i in kept["decontamination"]])
    assert kept["mix_sources"] == Counter(i for _, i in want) and max(kept["mix_sources"].values()) > 1
    rows = docs.collect()
    # In the order of the schedule, as far as documents come once.
    slot = {i: s for s, i in want if kept["mix_sources"][i] == 1}
    order = [slot[r.doc_id] for r in rows if r.doc_id in slot]
    assert order == sorted(order)
    from tokenizers import Tokenizer

    want = brute.token_rows([(r.doc_id, r.text) for r in rows], Tokenizer.from_file(tokenizer_path()))
    got = sorted(tuple(r) for r in P.STAGES[4][1](spark, docs, str(tmp_path)).collect())
    assert got == sorted(want)
    assert P.run(spark, str(tmp_path)).count() == len(rows)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_in_every_stage(spark, tmp_path):
    """Null and repeated ids, repeated rows, null texts and sources, and columns with the stages' and operators' own names: each stage gives rows of what it got, with all columns, and drops only what it is to drop."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    say = lambda n: " ".join(word() for _ in range(n))
    item, a, b = say(30), say(60), say(50)
    rows = [(None, a, "s"), (None, a, "s"), (1, b, None), (1, b, None), (2, b, "s"), (3, None, "s"), (None, None, None), (4, f"{say(9)} {item}", "t"), (None, f"{item} {say(9)}", "t"), (5, say(70), "t"), (5, say(40), "s"), (6, "12", "s")]
    names = ["row", "at", "slot", "score", "_stage_lang", "_stage_row", "_lid_text", "_q_text", "rep", "size"]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or ""), *[f"{k}" for _ in names]) for k, (i, t, s) in enumerate(rows)], f"doc_id bigint, text string, lang string, source string, n_chars bigint, {', '.join(f'{n} string' for n in names)}")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    run = lambda name: {k: f for k, f in P.STAGES}[name](spark, docs, str(tmp_path))
    kept = lambda df: Counter(int(r["row"]) for r in df.collect())
    got = {n: run(n) for n in ("language_id", "minhash_near_dedup", "decontamination", "mix_sources")}
    assert all(df.columns == docs.columns for df in got.values())
    rows_of = {k: tuple(r) for k, r in enumerate(docs.collect())}
    assert all(tuple(r) == rows_of[int(r["row"])] for df in got.values() for r in df.collect())
    assert kept(got["language_id"]) == Counter(k for k, (_, t, _) in enumerate(rows) if t and t != "12")
    # Rows without an id stay; of the others only document 2, whose text is document 1's, goes.
    assert kept(got["minhash_near_dedup"]) == Counter(k for k, (i, _, _) in enumerate(rows) if i != 2)
    assert kept(got["decontamination"]) == Counter(k for k in range(len(rows)) if k not in (7, 8))
    mixed = kept(got["mix_sources"])
    assert max(mixed.values()) <= 3 and not set(mixed) & {3, 6}
    tokens = run("token_files")
    assert tokens.count() == len(rows) and Counter(r.doc_id for r in tokens.collect()) == Counter(i for i, _, _ in rows)
