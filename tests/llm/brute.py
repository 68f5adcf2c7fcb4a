"""Plain-Python versions of the operators, for comparison on small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})

# The patterns as they are asked for, without any of the operator's rewriting.
KINDS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(d: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def holds(kind: str, m: str) -> bool:
    d = re.sub(r"[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and luhn(d)
    return 10 <= len(d) <= 15 if kind == "phone" else True


def personal(text: str | None) -> list[tuple[int, int, str, int]]:
    """(start, rank, kind, end), sorted."""
    t = text or ""
    return sorted((m.start(), i, k, m.end()) for i, (k, p) in enumerate(KINDS.items()) for m in p.finditer(t) if holds(k, m.group()))


def personal_sha(text: str | None) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in personal(text)).encode()).hexdigest()


def shingle_set(text: str | None, n: int) -> frozenset[str]:
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(" ".join(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([" ".join(w)] if w else [])


def components(ids: list[int], linked) -> dict[int, int]:
    up = {i: i for i in ids}

    def root(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if linked(a, b):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def near(texts: dict[int, str | None], n: int, percent: int) -> dict[int, tuple[int, int]]:
    s = {i: shingle_set(t, n) for i, t in texts.items()}
    comp = components(sorted(s), lambda a, b: bool(s[a]) and bool(s[b]) and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]))
    return {i: (len(s[i]), comp[i]) for i in s}


def token_rows(docs: list[tuple[int, str | None]], tokenizer, end: int = 1) -> list[tuple[int, int, int, int]]:
    out, start = [], 0
    for i, t in sorted(docs):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]
        out.append((i, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        start += len(ids)
    return out


def warc_rows(pages: list[tuple[int, str | None]]) -> list[tuple]:
    first: dict[bytes, int] = {}
    for p, h in sorted(pages):
        first.setdefault((h or "").encode(), p)
    out = []
    for p, h in pages:
        b = (h or "").encode()
        own = first[b] == p
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if own else "revisit", None if own else first[b]))
    return out


def chat_rows(turns: list[tuple]) -> dict[int, tuple]:
    """conv_id -> n_turns, turns_sha256, loss_chars, loss_sha256."""
    by: dict[int, list] = {}
    for c, t, r, x in turns:
        by.setdefault(c, []).append((t, r or "", x or ""))
    out = {}
    for c, ts in by.items():
        ts.sort()
        loss = "".join(x for _, r, x in ts if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(ts), sha("".join(f"{r}\n{x}\n" for _, r, x in ts)), len(loss), sha(loss))
    return out


def _mixed(h: int) -> int:
    """The public splitmix64 finaliser on Python's own integers."""
    m = (1 << 64) - 1
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & m
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & m
    return h ^ h >> 31


def trigrams(text: str | None, buckets: int) -> list[int]:
    c = [32 if ord(x) < 33 else ord(x) for x in (text or "").lower()]
    return [_mixed(a << 42 | b << 21 | d) % buckets for a, b, d in zip(c, c[1:], c[2:])]


def languages(train: list[tuple[int, str, str]], texts: dict[int, str | None], buckets: int) -> dict[int, tuple[str, float]]:
    """Naive Bayes with half a count of smoothing: id -> language and its posterior."""
    import math
    from collections import Counter

    counts: dict[str, Counter] = {}
    docs: Counter = Counter()
    for _, t, g in train:
        counts.setdefault(g, Counter()).update(trigrams(t, buckets))
        docs[g] += 1
    total = {g: sum(c.values()) for g, c in counts.items()}
    out = {}
    for i, t in texts.items():
        if not any(x.isalpha() for x in t or ""):
            out[i] = ("und", 0.0)
            continue
        seen = Counter(trigrams(t, buckets))
        logs = {g: math.log(docs[g] / sum(docs.values())) + sum(n * math.log((c[x] + 0.5) / (total[g] + 0.5 * buckets)) for x, n in seen.items()) for g, c in sorted(counts.items())}
        best = max(logs, key=lambda g: logs[g])
        out[i] = (best, 1 / sum(math.exp(v - logs[best]) for v in logs.values()))
    return out


def shapes(text: str) -> list[str]:
    """Words as runs of classes: letters, capitals, digits and each mark."""
    out = []
    for x in text:
        for b in x.encode():
            c = "A" if 65 <= b <= 90 else "0" if 48 <= b <= 57 else "a" if 97 <= b <= 122 or b >= 128 else chr(b)
            if not out or out[-1] != c:
                out.append(c)
    return re.split(r"[\x00-\x20]+", "".join(out))


def ngrams(text: str | None) -> dict[tuple, int]:
    """The classifier's n-grams by name: words, pairs of words, their shapes and pairs of shapes."""
    from collections import Counter

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x00-\x20]+", low) if x]
    s = [x for x in shapes(text or "") if x]
    out = Counter(("w", x) for x in w) + Counter(("s", x) for x in s)
    out += Counter(("same",) if a == b else ("ww", a, b) for a, b in zip(w, w[1:]))
    out += Counter(("ss", a, b) for a, b in zip(s, s[1:]))
    return dict(out)


def ftrl(examples: list[tuple[dict, int]], alpha: float, beta: float, l1: float, l2: float, epochs: int) -> dict:
    """FTRL-proximal over named features, one weight at a time."""
    import math

    z: dict = {}
    n: dict = {}

    def weight(k):
        a = z.get(k, 0.0)
        return 0.0 if abs(a) <= l1 else -(a - math.copysign(l1, a)) / ((beta + math.sqrt(n.get(k, 0.0))) / alpha + l2)

    for _ in range(epochs):
        for x, y in examples:
            w = {k: weight(k) for k in x}
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w[k] * v for k, v in x.items())))))
            for k, v in x.items():
                g = (p - y) * v
                s = (math.sqrt(n.get(k, 0.0) + g * g) - math.sqrt(n.get(k, 0.0))) / alpha
                z[k] = z.get(k, 0.0) + g - s * w[k]
                n[k] = n.get(k, 0.0) + g * g
    return {k: weight(k) for k in z}


def values(text: str | None) -> dict:
    """Log counts of length 1 in all, with the bias."""
    import math

    n = {k: math.log1p(c) for k, c in ngrams(text).items()}
    length = math.sqrt(sum(v * v for v in n.values())) or 1.0
    return {k: v / length for k, v in n.items()} | {"bias": 1.0}


def terms_of(text: str) -> list[str]:
    """Words of three characters or more in lower case, from the first letter or digit to the last."""
    out = []
    for w in WORD.findall(text.lower()):
        at = [i for i, x in enumerate(w) if x.isalpha() or x.isnumeric()]
        if at and at[-1] - at[0] >= 2:
            out.append(w[at[0] : at[-1] + 1])
    return out


MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}


def sanitised(texts: list[str | None], reach: int = 8, support: int = 3, generalise: float = 0.75, remove: float = 0.999) -> list[tuple[list[tuple[int, int, str, int]], int, int, str]]:
    """Of each text all spans, terms that disclose its entities among them, by counting every pair; how many terms are generalised and removed, and the clean text."""
    import math
    from collections import Counter

    texts = [t or "" for t in texts]
    base = [personal(t) for t in texts]
    name = lambda t, s: s[2] + ":" + (t[s[0] : s[3]].lower() if s[2] == "email" else re.sub(r"[^0-9.]", "", t[s[0] : s[3]]))
    held = [{name(t, s) for s in b} for t, b in zip(texts, base)]
    df_t = Counter(w for t in texts for w in set(terms_of(t)))
    df_e = Counter(e for h in held for e in h)
    c: Counter = Counter()
    for t, b in zip(texts, base):
        near = set()
        words = [(m.start(), m.end(), (terms_of(m.group()) or [""])[0]) for m in WORD.finditer(t)]
        for s in b:
            left = [w for a, z, w in words if z <= s[0]][-reach:]
            right = [w for a, z, w in words if a >= s[3]][:reach]
            near |= {(name(t, s), w) for w in left + right if w}
        c.update(near)
    n, share = len(texts), {}
    for (e, w), k in c.items():
        content = math.log2(n / (df_e[e] if k >= support else k))
        share[e, w] = math.log2(k * n / (df_t[w] * df_e[e])) / content if content > 0 else 0.0
    out = []
    for t, b, h in zip(texts, base, held):
        more, mark = [], {}
        for m in WORD.finditer(t):
            w = (terms_of(m.group()) or [""])[0]
            most = max((share.get((e, w), -1e9) for e in h), default=-1e9)
            if most >= generalise and not any(s[0] < m.end() and m.start() < s[3] for s in b):
                more.append((m.start(), len(KINDS), "term", m.end()))
                mark[m.start()] = "" if most >= remove else "[NUMBER]" if re.search("[0-9]", m.group()) else "[WORD]"
        spans, clean, at = sorted(b + more), "", 0
        for a, _, kind, z in spans:
            if a >= at:
                clean += t[at:a] + (mark[a] if kind == "term" else MARKS[kind])
                at = z
        out.append((spans, sum(x != "" for x in mark.values()), sum(x == "" for x in mark.values()), clean + t[at:]))
    return out


def runs(words: list[str], n: int = 5) -> set[tuple]:
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def plain_terms(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower()) if w]


def holds_item(text: str | None, item: str | None, parts: tuple[str, str]) -> str | None:
    """What of an item a text holds, by the rule that decontamination states."""
    own = plain_terms(text)
    told, known = f" {' '.join(own)} ", runs(own)

    def share(part: str | None) -> float:
        r = runs(plain_terms(part))
        return sum(x in known if len(x) >= 5 else f" {' '.join(x)} " in told for x in r) / len(r) if r else 0.0

    whole, question, answer = share(item), share(parts[0]), share(parts[1])
    asked = len(plain_terms(parts[0])) >= 5 and question >= 0.8
    answered = len(plain_terms(parts[1])) >= 5 and answer >= 0.8
    if asked:
        return "question and answer" if answered else "question"
    if answered and question >= 0.5:
        return "answer"
    return "whole" if whole >= 0.8 else None


def chat_windows(rows: list[tuple], budget: int, history: int) -> dict:
    """conv_id -> (text, tokens, repeated) of each window, from rows (conv_id, turn, role, text), by one walk over each conversation."""
    convs: dict = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn is None, turn or 0, role or "", text or ""))
    out: dict = {}
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        shown = ["<|im_start|>" + r.replace("%", "%25").replace("\n", "%0A").replace("<|", "<%7C") + "\n" + re.sub(r"<(\\*)\|", r"<\1\\|", t) + "<|im_end|>\n" for _, _, r, t in turns]
        tokens = [-(-len(s) // 4) + 4 for s in shown]
        led = turns[0][2] == "system"
        lead = tokens[0] if led else 0
        room = max(budget - history - lead, 1)
        most = max(room // 4, 1)
        spans, longs, before = [], 0, 0
        for k, n in enumerate(tokens):
            if led and k == 0:
                spans.append(None)
            elif n > most:
                longs += 1
                spans.append((2 * longs - 1) * 2**32 + before // max(room - most, 1))
            else:
                spans.append(2 * longs * 2**32 + before // max(room - most, 1))
                before += n
        if led:
            spans[0] = spans[1] if len(spans) > 1 else 0
        out[c] = []
        held: list[int] = []
        for span in sorted(set(spans)):
            own = [k for k, s in enumerate(spans) if s == span]
            head = [0] if led and 0 not in own else []
            all_ = head + held + own
            out[c].append(("".join(shown[k] for k in all_), sum(tokens[k] for k in all_), len(head) + len(held)))
            held, size = [], 0
            for k in reversed(own):
                size += tokens[k]
                if size > history or (led and k == 0):
                    break
                held.insert(0, k)
    return out


def mixed(rows: list[tuple], block: int = 512, repeats: int = 3) -> list[tuple[int, int]]:
    """(slot, doc_id) of each repeat of a document of which half of the words or more are taken, by the schedule's slots; rows (doc_id, text, source)."""
    import math

    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, target = set(names), {}
    while left:
        share = (sum(sizes.values()) - sum(target.values())) / sum(weight[s] for s in left)
        full = {s for s in left if share * weight[s] > repeats * sizes[s]}
        if not full:
            target |= {s: share * weight[s] for s in left}
            break
        target |= {s: float(repeats * sizes[s]) for s in full}
        left -= full
    goal = {s: math.floor(target[s] + 0.5) for s in names}
    quota = {s: -(-goal[s] // block) for s in names}
    ends, at = {}, 0.0
    for s in names:
        at += target[s]
        ends[s] = at / max(sum(target.values()), 1)
    ends[names[-1]] = 1.0
    slot_of, given, free = {}, dict.fromkeys(names, 0), []
    for slot in range(sum(quota.values())):
        u = (slot + 1) * 0.6180339887498949
        u -= math.floor(u)
        s = next(s for s in names if u < ends[s])
        if given[s] < quota[s]:
            slot_of[s, given[s]] = slot
        else:
            free.append(slot)
        given[s] += 1
    rest = [(s, r) for s in names for r in range(given[s], quota[s])]
    slot_of |= dict(zip(rest, free))
    out, start = [], dict.fromkeys(names, 0)
    for i, t, s in sorted(rows, key=lambda r: (hashlib.md5(f"mix:{r[0]}".encode()).hexdigest(), r[0])):
        n = len(WORD.findall(t or ""))
        for k in range(repeats):
            a = start[s] + k * sizes[s]
            z = min(a + n, goal[s])
            if a < z and 2 * (z - a) >= n:
                out.append((min(slot_of[s, r] for r in range(a // block, (z - 1) // block + 1)), i))
        start[s] += n
    return sorted(out)
