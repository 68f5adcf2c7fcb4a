"""Merkle manifests, quality rules and spelling variants on small tables, against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from relweave.llm import merkle, rules, spelling
from relweave.llm.queries import QUERIES

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, rank int, tree string, key string, n int"
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def _write(spark, path, rows):
    """documents with columns that have names the operators use inside."""
    spark.createDataFrame([(i, t, lang, s, len(t or ""), "x", 1, "y", "z", 2) for i, t, lang, s in rows], DOC).write.parquet(f"{path}/documents.parquet")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _tree(leaves):
    """Levels of nodes, leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def _path(levels, k):
    out = []
    for nodes in levels[:-1]:
        a = k // 16 * 16
        out.append(("".join(nodes[a:k]), "".join(nodes[k + 1 : a + 16])))
        k //= 16
    return out


def _manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded root) of rows (doc_id, text, lang, source)."""
    made = [(i, t, lang, s, H(*map(_field, (i, s, lang, len(t or ""), t)))) for i, t, lang, s in rows]
    names = sorted({r[3] for r in made}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted((r for r in made if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, r[4])) for s in names}
    levels = {s: _tree([r[4] for r in trees[s]]) for s in names}
    top = _tree([levels[s][-1][0] for s in names])
    out = []
    for n, s in enumerate(names):
        for k, (i, t, lang, _, leaf) in enumerate(trees[s]):
            path = _path(levels[s], k) + _path(top, n)
            node = leaf
            if i is not None and zlib.crc32(str(i).encode()) % 5 == 0:
                node = H(*map(_field, (i, s, lang, len(t or ""), None if t is None else t.translate(LOW))))
            for left, right in path:
                node = H(left, node, right)
            out.append((i, leaf, levels[s][-1][0], top[-1][0], H(*(a + b for a, b in path)), node, node == top[-1][0]))
    return out


def _order(rows):
    return sorted(rows, key=lambda r: tuple("" if x is None else str(x) for x in r))


@pytest.mark.parametrize("levels", [1, 3])
def test_merkle(spark, tmp_path, monkeypatch, levels):
    """Small blocks make many of them, so that paths go through upper levels; runs of one, lone leaves, null ids, sources and texts, repeated rows, a very long text."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    rng = random.Random(7)
    rows = [(i, f"Text {rng.random()} É", "en", "hot") for i in range(290)] + [(i, f"t{i}", None, "b") for i in range(300, 317)]
    rows += [(400, None, "en", None), (None, "No Id", "en", "hot"), (None, "No Id", "en", "hot"), (401, "", "de", ""), (402, "Lone", "de", "null"), (403, "X" * 300_000, "de", "hot")]
    rows += [(5, rows[5][1], "en", "hot")] * 3 + [(500 + i, "Same", "fr", f"s{i:02}") for i in range(15)]
    _write(spark, tmp_path, rows)
    got = QUERIES["op11_merkle_manifest"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = [tuple(r) for r in got.collect()]
    assert _order(got) == _order(_manifest(rows)) and not all(r[-1] for r in got) and sum(r[-1] for r in got) > 200


def test_merkle_small(spark, tmp_path):
    for k, rows in enumerate(([], [(1, "One", "en", "a")], [(1, None, None, None), (2, None, None, None)])):
        _write(spark, f"{tmp_path}/{k}", rows)
        assert _order(tuple(r) for r in QUERIES["op11_merkle_manifest"](spark, f"{tmp_path}/{k}").collect()) == _order(_manifest(rows))


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 256, 257, 300, 4096])
def test_fractal(n):
    """Paths of the traversal are those of the whole tree, and no level ever holds more than two runs."""
    leaves = [H(str(i)) for i in range(n)]
    levels = _tree(leaves)
    f = merkle.Fractal(leaves, merkle.levels_of(n))
    assert f.root() == levels[-1][0]
    for k, (left, right) in enumerate(f.paths()):
        assert list(zip(left, right, strict=True)) == _path(levels, k)
        assert all(len(a) <= 16 and len(b) <= 16 for a, b in zip(f.existing, f.desired, strict=True))


def test_manifest_keeps_columns(spark):
    """General use: other names, and columns that are kept."""
    rows = spark.createDataFrame([("a", 2, H("2"), "x"), ("a", 1, H("1"), "y"), (None, 9, H("9"), "z")], "part string, at int, leaf string, note string")
    got = {r.note: r for r in merkle.manifest(rows, "part", ["at"], ["note", "part"]).collect()}
    assert got["y"].rank == 0 and got["x"].rank == 1 and got["z"].part is None and got["z"].subroot == H("9")
    assert got["x"].subroot == H(H("1"), H("2")) and got["x"].root == H(H("9"), got["x"].subroot)
    assert [tuple(p) for p in got["x"].path] == [(H("1"), ""), (H("9"), "")]


def _statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    covered = {k for i, w in enumerate(windows) if n[w] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines)


def _vector(s):
    n, chars, symbols, dup, rep, lines = s
    units = [np.log1p(n), np.log1p(chars / max(n, 1)), np.log1p(100 * symbols / max(chars, 1)), np.log1p(100 * dup / max(lines, 1)), np.log1p(100 * rep / max(n, 1))]
    return [float(np.floor(u * 1024 + 0.5)) for u in units]


def _mcd(x):
    """The estimate's distances of the rows of x, by the same steps with matrices."""
    floors = np.array(rules.FLOORS) * 1024
    n = len(x)
    at = lambda q: np.sort(x, axis=0)[int(np.ceil(n * q - 1e-9)) - 1]
    m, s = at(0.5), np.maximum((at(0.75) - at(0.25)) / 1.349, floors)
    z = (x - m) / s
    norm = np.linalg.norm(z, axis=1, keepdims=True)
    starts = [np.diag(s**2)]
    for y in (np.tanh(z), np.divide(z, norm, out=np.zeros_like(z), where=norm > 0)):
        y = np.sign(y) * np.floor(np.abs(y) * 1024 + 0.5)
        starts.append(np.cov(y.T, bias=True) * np.outer(s, s) / 1024**2)
    fits = [(m, c + np.diag(floors**2)) for c in starts]
    dist = lambda f: np.einsum("ij,jk,ik->i", x - f[0], np.linalg.inv(f[1]), x - f[0])
    for _ in range(rules.MOST_ROUNDS):
        after, edges = [], []
        for f in fits:
            cut = np.floor(np.log2(1 + dist(f)) * rules.SLICES + 1e-9)
            last = np.sort(cut)[int(np.ceil(n * rules.SUPPORT - 1e-9)) - 1]
            near = x[cut <= last]
            after.append((near.mean(0), np.cov(near.T, bias=True) + np.diag(floors**2)))
            edges.append(2 ** ((last + 1) / rules.SLICES) - 1)
        fits = after
    k = int(np.argmin([round(np.linalg.slogdet(f[1])[1], 9) for f in fits]))
    return dist(fits[k]) / max(edges[k] / rules.CHI_SUPPORT, 1)


@pytest.fixture(scope="module")
def judged_docs():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n))
    rows = []
    for i in range(420):
        text = "\n".join(line(rng.randrange(3, 15)) for _ in range(rng.randrange(3, 30)))
        if i % 20 == 0:
            text = " ".join(w + rng.choice("#*$%|") * 3 for w in text.split(" "))
        if i % 31 == 0:
            text += "\n" + text.split("\n")[0]
        rows.append((i, text, "en" if i % 3 else "de", f"s{i % 2}" if i < 400 else f"rare{i}"))
    rows += [(500, None, "en", "s0"), (501, "", None, None), (502, " \n\t\n ", "en", "s1"), (503, line(19), "en", "s1"), (504, line(20), "en", None), (None, line(25), None, "s0")]
    rows += [(505, " ".join(["one two three four five six seven eight nine"] * 5), "en", "s0"), (506, "é" * 100_000, "en", "s0"), (507, line(40_000), "en", "s0"), (7, rows[7][1], "de", "s1")]
    return rows


def test_rules(spark, tmp_path, judged_docs):
    _write(spark, tmp_path, judged_docs)
    out = QUERIES["op12_quality_rules"](spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want, groups = [], {}
    sizes = Counter()
    for i, t, lang, s in judged_docs:
        x = _statistics(t)
        failed = x[0] < 20 or 100 * x[4] > 30 * x[0]
        want.append([i, *x[:5], failed, not failed])
        if not failed:
            sizes[lang, s] += 1
    rest = Counter()
    for (lang, _), n in sizes.items():
        rest[lang] += n * (n < rules.MIN_GROUP)
    last = sum(n for (lang, _), n in sizes.items() if n < rules.MIN_GROUP and rest[lang] < rules.MIN_GROUP)
    for row, (_, t, lang, s) in zip(want, judged_docs, strict=True):
        if not row[6]:
            key = (2, lang, s) if sizes[lang, s] >= rules.MIN_GROUP else (1, lang) if rest[lang] >= rules.MIN_GROUP else (0,) if last >= rules.MIN_GROUP else None
            groups.setdefault(key, []).append((row, _vector(_statistics(t))))
    for key, rows in groups.items():
        if key is not None:
            for (row, _), d in zip(rows, _mcd(np.array([v for _, v in rows])), strict=True):
                row[7] = bool(d <= rules.CHI_REJECT)
    assert _order(tuple(r) for r in out.collect()) == _order(map(tuple, want))
    # The method decides: documents full of symbols pass the fixed rules and go, all others that pass them stay.
    by = {r[0]: r for r in want}
    assert all(not by[i][7] for i in range(0, 400, 20) if not by[i][6]) and sum(not r[6] and not r[7] for r in want) <= 25


def test_rules_small(spark):
    """Too few documents for any estimate: the fixed rules alone; no rows: none; clashing columns don't matter."""
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(1, long, "en", "s", 0, "", 0, "", "", 0), (2, long + " ###", None, None, 0, "", 0, "", "", 0), (3, "short", "en", "s", 0, "", 0, "", "", 0)]
    got = {r.doc_id: (r.kept, r.distance) for r in rules.judged(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {1: (True, None), 2: (True, None), 3: (False, None)}
    assert rules.judged(spark.createDataFrame([], DOC)).count() == 0


def test_repeated_words_in_spark(spark):
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(k)}" for _ in range(n)) for k in (1, 2, 3, 9, 400) for n in (0, 1, 7, 8, 9, 15, 16, 17, 40, 300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    words = F.regexp_extract_all("text", F.lit(rules.WORD), F.lit(0))
    got = {r.i: r.n for r in rows.select("i", rules.let(words, lambda ws: rules.repeated_words(ws)).alias("n")).collect()}
    assert got == {i: _statistics(t)[4] for i, t in enumerate(texts)}


def test_rules_are_native(spark, judged_docs, tmp_path):
    """No Python node is in any plan of the main path."""
    _write(spark, tmp_path, judged_docs)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = rules.statistics(docs)
    passing = rules.keyed(rows.select("doc_id", "lang", "source", *rules.STATS, *rules.vector()), 50)
    fits = rules.starts(passing.where("key is not null"))
    for df in (rows, passing, fits, rules.concentrated(passing, fits.drop("det"), 0.75), rules.judged(docs)):
        assert not re.search("Python|Pandas|Arrow|RDD", df._jdf.queryExecution().optimizedPlan().toString())


def _variants(docs):
    n = Counter()
    for i, t, *_ in docs:
        for w, c in Counter(x.translate(LOW) for x in re.findall("[A-Za-zÀ-ÿ]+", t or "")).items():
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += c
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    beside = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, xs in beside.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(beside[w]), n[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("part", [2048, 3])
def test_spelling(spark, tmp_path, monkeypatch, part):
    monkeypatch.setattr(spelling, "LIST_WORDS", part)
    rng = random.Random(9)
    base = ["".join(rng.choice("abÀÿñ") for _ in range(rng.randrange(7, 11))) for _ in range(12)]
    pool = list(base)
    for w in base:
        for _ in range(8):
            k, c = rng.randrange(len(w)), rng.choice("abzé")
            pool += [w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]]
    # A chain of forms, ties, runs of one letter.
    chain = [("abcdefgh", 1200), ("abcdefgx", 100), ("abcdefyx", 8), ("qrstuvw", 40), ("qrstuvx", 40), ("qrstuvy", 2), ("aaaaaaa", 3), ("aaaaaaaa", 50), ("aaaaaaaaa", 4)]
    words = [w for w in pool for _ in range(rng.choice((1, 2, 3, 40)))] + [w for w, n in chain for _ in range(n)]
    rng.shuffle(words)
    docs = [(i, " ".join(w.upper() if w.isascii() and rng.random() < 0.2 else w for w in words[a : a + 60]) + " 12,ő", "en", "s") for i, a in enumerate(range(0, len(words), 60))]
    docs += [(None, "abcdefgh1abcdefgh", "en", "s"), (900, None, "en", "s"), (901, "", "en", "s"), (902, "é" * 50_000 + " " + "é" * 50_000, "en", "s"), (3, docs[3][1], "en", "s")]
    _write(spark, tmp_path, docs)
    got = QUERIES["op13_spelling_variants"](spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in got.collect()]
    want = _variants(docs)
    assert _order(got) == _order(want)
    root = {r[0]: r[2] for r in want}
    assert root["abcdefyx"] == "abcdefgh" and root["qrstuvy"] == "qrstuvw" and any(r[4] > 5 for r in want)


def test_spelling_small(spark, tmp_path):
    for k, rows in enumerate(([], [(1, None, "en", "s")], [(1, "wonderful wonderful", "en", "s")])):
        _write(spark, f"{tmp_path}/{k}", rows)
        assert _order(tuple(r) for r in QUERIES["op13_spelling_variants"](spark, f"{tmp_path}/{k}").collect()) == _order(_variants(rows))
    rows = spark.createDataFrame([(None, 5), ("short", 3), ("shorts", 90), ("𝒳abcdefg", 3), ("abcdefg", 30)], "word string, n int")
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.variants(rows).collect()}
    assert got == {"short": (None, "short", 0), "shorts": (None, "shorts", 0), "𝒳abcdefg": ("abcdefg", "abcdefg", 1), "abcdefg": (None, "abcdefg", 1)}
