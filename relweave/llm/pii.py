"""Personal data: patterns, and terms that give protected entities away by corpus co-occurrence. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relweave.llm.common import stored

#: Words on either side of an entity that count as occurring with it.
REACH = 8
#: Documents in which a term must occur with an entity to be measured by the entity's content alone; rarer pairs are judged by their own.
SUPPORT = 3
#: Matches that are summed in one array.
CHUNK = 256
#: Shares of the entity's information content: terms that give away so much are generalised, or removed.
GENERALISE, REMOVE = 0.75, 0.999

# The kinds and their patterns. Quantifiers that nothing can follow up are possessive and a match begins where a run
# begins (or the last match ended): the matches are the same, without backtracking into runs of any length.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to be looked for.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[\p{L}\p{N}][^\x20\x09-\x0D]+[\p{L}\p{N}]"


def located(text: Column, pattern: str, wanted: Callable[[Column], Column] = lambda value: F.lit(True)) -> Column:
    """Leftmost matches without overlap whose value is wanted, as array<struct<start, end, value>>, in code points.

    Splitting gives what lies between matches, so the sums of lengths give the places. An array grows by copying, so matches are summed in groups of CHUNK, and the groups joined at the end: a text of n matches costs n * (CHUNK + n / CHUNK) instead of n * n copies."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    step = lambda acc, x: F.struct(
        (acc.at + x.gap + F.length(x.value)).alias("at"),
        F.when(wanted(x.value), F.concat(acc.out, F.array(F.struct((acc.at + x.gap).alias("start"), (acc.at + x.gap + F.length(x.value)).alias("end"), x.value.alias("value"))))).otherwise(acc.out).alias("out"),
    )
    chunk = lambda acc, x: F.aggregate(x, F.struct(acc.at.alias("at"), empty.alias("out")), step, lambda got: F.struct(got.at.alias("at"), F.concat(acc.out, F.array(got.out)).alias("out")))
    none = F.array().cast("array<array<struct<start:int,end:int,value:string>>>")
    summed = lambda both: F.flatten(F.aggregate(chunked(both), F.struct(F.lit(0).alias("at"), none.alias("out")), chunk, lambda acc: acc.out))
    pairs = lambda found: F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(g.alias("gap"), m.alias("value")))
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) == 0, empty).otherwise(let(pairs(found), summed)))


def chunked(items: Column) -> Column:
    """An array's elements in arrays of CHUNK; one empty array for none."""
    last = lambda x: F.greatest(F.floor((F.size(x) - 1) / CHUNK), F.lit(0)).cast("int")
    return let(items, lambda x: F.transform(F.sequence(F.lit(0), last(x)), lambda i: F.slice(x, i * CHUNK + 1, F.lit(CHUNK))))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def luhn(digits: Column) -> Column:
    """Whether up to 19 digits pass Luhn's check."""
    n = F.length(digits)
    value = lambda i: F.substring(digits, F.lit(1) + n - i, F.lit(1)).cast("int")
    part = lambda i: F.when(i % 2 == 1, value(i)).otherwise(value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + part(i)) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern holds up."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        byte = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?"
        return value.rlike(rf"^(?:{byte}\.){{3}}{byte}$")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _of_kind(found: Column, rank: int, kind: str) -> Column:
    holds = F.filter(found, lambda m: valid(kind, m.value))
    return F.transform(holds, lambda m: F.struct(m.start.alias("start"), F.lit(rank).alias("rank"), m.end.alias("end"), F.lit(kind).alias("kind"), m.value.alias("value")))


def _count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")


def base_spans(docs: DataFrame) -> DataFrame:
    """docs with `base`: array<struct<start, end, rank, kind, value>> by start, then kind; null text: none."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    parts = []
    for i, kind in enumerate(KINDS):
        needed = F.lit(True) if NEEDS[kind] is None else F.instr(text, NEEDS[kind]) > 0
        if kind != "email":
            needed = needed & text.rlike("[0-9]")
        none = F.array().cast("array<struct<start:int,end:int,value:string>>")
        parts.append(_of_kind(F.when(needed, located(text, PATTERNS[kind])).otherwise(none), i, kind))
    return docs.withColumn("base", F.array_sort(F.concat(*parts)))


def terms(text: Column) -> Column:
    """The text's words in lower case without marks at their ends, those of three characters or more: each from its first letter or digit to its last."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def trimmed(word: Column) -> Column:
    return F.regexp_replace(word, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def entity(span: Column) -> Column:
    """What a span's value stands for: kind and value in lower case, numbers by their digits."""
    return F.concat_ws(":", span.kind, F.when(span.kind == "email", F.lower(span.value)).otherwise(F.regexp_replace(span.value, "[^0-9.]", "")))


def contexts(text: Column, spans: Column, reach: int) -> Column:
    """For each span the distinct terms of the `reach` words on either side, words that overlap it left out; spans and what comes back in one order.

    Words are located once. How many begin before a place is found among the first words of chunks, and then within one chunk, so a span costs a chunk and a CHUNKth of the words, not the text."""
    term = lambda w: F.regexp_extract(F.lower(w.value), TERM, 0)

    def around(words: Column) -> Column:
        def of(chunks: Column, heads: Column) -> Column:
            begun = lambda place: let(F.size(F.filter(heads, lambda h: h < place)), lambda c: F.when(c == 0, 0).otherwise((c - 1) * CHUNK + F.size(F.filter(F.get(chunks, c - 1), lambda w: w.start < place))))
            left = lambda s: let(begun(s.start), lambda i: i - F.when((i > 0) & (F.get(words, i - 1).end > s.start), 1).otherwise(0))
            cut = lambda s: F.concat(let(left(s), lambda i: F.slice(words, F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)))), let(begun(s.end), lambda j: F.slice(words, j + 1, F.lit(reach))))
            return F.transform(spans, lambda s: F.array_distinct(F.filter(F.transform(cut(s), term), lambda t: t != "")))

        return let(chunked(words), lambda chunks: let(F.filter(F.transform(chunks, lambda c: F.get(c, F.lit(0)).start), lambda h: h.isNotNull()), lambda heads: of(chunks, heads)))

    return let(located(text, WORD), around)


def disclosing(docs: DataFrame, found: DataFrame, reach: int = REACH, support: int = SUPPORT, generalise: float = GENERALISE) -> DataFrame:
    """(entity, term, share, df_e, df_t): terms near an entity that give it away, from counts over all docs; every pair is judged.

    docs (text) is the corpus, found (key, text, base) its documents with entities. With N documents, of which df(t) hold the term, df(e) the entity, and c hold the term within `reach` words of the entity, the disclosed information is log2(c * N / (df(t) * df(e))) and the entity's content log2(N / df(e)); share is their ratio. Few documents are weak evidence: where c is below `support`, the content is that of the pair, log2(N / c), instead. That is the same if all the entity's documents hold the term, as with an entity of one document, and more, hence a smaller share, the more of them don't. Counts of words are aggregated before each shuffle, and a window of words bounds the pairs that a mention gives; texts stay where they are."""
    both = F.zip_with("base", contexts(F.col("text"), F.col("base"), reach), lambda s, near: F.struct(entity(s).alias("entity"), near.alias("near")))
    mentions = found.select("key", F.explode(both).alias("m")).select("key", "m.entity", "m.near")
    near = mentions.select("key", "entity", F.explode("near").alias("term")).distinct()
    pairs = stored(near.groupBy("entity", "term").agg(F.count("*").alias("c")), "pairs")
    if pairs.isEmpty():
        return pairs.select("entity", "term", F.lit(0.0).alias("share"), F.col("c").alias("df_e"), F.col("c").alias("df_t"))
    n = docs.count()
    of_entity = entities(found).groupBy("entity").agg(F.count("*").alias("df_e"))
    of_term = docs.select(F.explode(F.array_distinct(terms(F.coalesce("text", F.lit(""))))).alias("term")).groupBy("term").agg(F.count("*").alias("df_t"))
    # Stored, so that the join reads plain rows and Spark can divide the pairs of a frequent term among tasks.
    of_term = stored(of_term.join(pairs.select("term").distinct(), "term", "left_semi"), "terms")
    judged = pairs.join(of_term, "term").join(of_entity, "entity")
    content = F.log2(F.lit(float(n)) / F.when(F.col("c") >= support, F.col("df_e")).otherwise(F.col("c")))
    share = F.when(content > 0, F.log2(F.col("c") * F.lit(float(n)) / (F.col("df_t") * F.col("df_e"))) / content).otherwise(0.0)
    return judged.select("entity", "term", share.alias("share"), "df_e", "df_t").where(F.col("share") >= generalise)


def entities(found: DataFrame) -> DataFrame:
    """(key, entity) of the entities that each document holds."""
    return found.select("key", F.explode(F.array_distinct(F.transform("base", entity))).alias("entity"))


def sanitise(docs: DataFrame, reach: int = REACH, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """(doc_id, spans, clean): one row for each row of docs (doc_id, text; other columns are ignored).

    spans: array<struct<start, rank, end, kind, value, mark>> in code points, by start and then kind: the personal data that patterns find, and kind `term` for words (not overlapping those) that disclose an entity of the same document. mark: what takes a span's place: its kind's mark for personal data; for terms that disclose `generalise` of an entity's information or more a mark of their sort ([NUMBER] or [WORD]), and nothing for those that disclose `remove` or more. clean: the text with the marks.

    - null text: as empty; null doc_id: a row like others; repeated rows count as documents; an empty table gives no rows
    Patterns are looked for once, and their spans stored with the texts. A document meets the terms that it holds and that disclose an entity that it holds: of a term and its entity, the one that fewer documents hold brings the documents."""
    based = stored(base_spans(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))).withColumn("key", F.monotonically_increasing_id()), "based")
    found = based.where(F.size("base") > 0)
    judged = stored(disclosing(based, found, reach, support, generalise), "judged")
    held = found.select("key", F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    by_term = held.join(judged.where("df_t <= df_e"), "term").join(entities(found), ["key", "entity"], "left_semi")
    by_entity = entities(found).join(judged.where("df_t > df_e"), "entity").join(held, ["key", "term"], "left_semi")
    wanted = by_term.select("key", "term", "share").unionByName(by_entity.select("key", "term", "share")).groupBy("key", "term").agg(F.max("share").alias("share"))
    # In each text the terms are looked up by a hash, in about as many lists as each list has terms.
    wanted = wanted.groupBy("key").agg(F.collect_list(F.struct("term", "share")).alias("w")).select("key", let(F.ceil(F.sqrt(F.size("w"))).cast("int"), lambda n: F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.filter("w", lambda x: F.pmod(F.xxhash64(x.term), n) == b))).alias("wanted"))
    listed = lambda t: F.get(F.col("wanted"), F.pmod(F.xxhash64(t), F.size("wanted")).cast("int"))
    hit = lambda w: let(F.lower(trimmed(w)), lambda t: F.get(F.filter(listed(t), lambda x: x.term == t), F.lit(0)).share)
    words = located(F.col("text"), WORD, lambda w: hit(w).isNotNull())
    # Only base spans within a chunk's reach are held against its words.
    meets = lambda s, start, end: (s.start < end) & (start < s.end)
    clear = lambda ws: let(F.filter("base", lambda s: meets(s, F.get(ws, F.lit(0)).start, F.get(ws, F.size(ws) - 1).end)), lambda near: F.filter(ws, lambda w: ~F.exists(near, lambda s: meets(s, w.start, w.end))))
    kind = "array<struct<start:int,rank:int,end:int,kind:string,value:string,mark:string>>"
    span = lambda s, rank, name, mark: F.struct(s.start.alias("start"), rank.alias("rank"), s.end.alias("end"), name.alias("kind"), s.value.alias("value"), mark.alias("mark"))
    term_mark = lambda w: F.when(hit(w.value) >= remove, F.lit("")).otherwise(F.when(w.value.rlike("[0-9]"), "[NUMBER]").otherwise("[WORD]"))
    marked = F.transform(F.flatten(F.transform(chunked(words), clear)), lambda w: span(w, F.lit(len(KINDS)), F.lit("term"), term_mark(w)))
    marks = F.create_map(*[F.lit(x) for pair in MARKS.items() for x in pair])
    base = F.transform("base", lambda s: span(s, s.rank, s.kind, marks[s.kind]))
    out = found.join(wanted, "key", "left").select("doc_id", "text", F.array_sort(F.concat(base, F.when(F.col("wanted").isNotNull(), marked).otherwise(F.array().cast(kind)))).alias("spans"))
    none = based.where(F.size("base") == 0).select("doc_id", F.array().cast(kind).alias("spans"), F.col("text").alias("clean"))
    return none.unionByName(out.select("doc_id", "spans", _replaced(F.col("text"), F.col("spans")).alias("clean")))


def _replaced(text: Column, spans: Column) -> Column:
    """The text with its mark in place of each span (by start; one that begins within a span before it is left out).

    Cutting a piece out of a text costs its place in it, and appending a copy of what there is; so each chunk of spans is cut out of the text once, and its spans out of that."""
    none = F.array().cast("array<string>")

    def chunk(acc: Column, part: Column) -> Column:
        upto = F.greatest(F.array_max(F.transform(part, lambda s: s.end)), acc.at)
        cut = lambda piece, got, to: F.substring(piece, got.at - acc.at + 1, to - got.at)
        step = lambda piece: lambda got, s: F.when(s.start >= got.at, F.struct(s.end.alias("at"), F.concat(got.out, F.array(cut(piece, got, s.start), s.mark)).alias("out"))).otherwise(got)
        done = lambda got: F.struct(got.at.alias("at"), F.concat(acc.out, F.array(F.array_join(got.out, ""))).alias("out"))
        return let(F.substring(text, acc.at + 1, upto - acc.at), lambda piece: F.aggregate(part, F.struct(acc.at.alias("at"), none.alias("out")), step(piece), done))

    rest = lambda acc: F.concat(F.array_join(acc.out, ""), F.substring(text, acc.at + 1, F.lit(2**31 - 1)))
    return F.aggregate(chunked(spans), F.struct(F.lit(0).alias("at"), none.alias("out")), chunk, rest)


def digest(rows: DataFrame) -> DataFrame:
    """Per document the counts by kind, a hash of the base spans, and all spans as text; n_generalised and n_removed (terms), and clean_sha256, the hash of the sanitised text."""
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    hashed = lambda text: F.sha2(text.cast("binary"), 256)
    terms_with = lambda empty: F.size(F.filter("spans", lambda s: (s.kind == "term") & ((s.mark == "") == empty))).cast("bigint")
    return rows.select("doc_id", *map(_count_of, KINDS), hashed(told(F.filter("spans", lambda s: s.kind != "term"))).alias("base_sha256"), told(F.col("spans")).alias("spans"), terms_with(False).alias("n_generalised"), terms_with(True).alias("n_removed"), hashed(F.col("clean")).alias("clean_sha256"))
