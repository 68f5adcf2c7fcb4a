"""RDF text as triples and back: RDF/XML, and Turtle as far as ontologies use it."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relweave.schemas import RDF_TYPE, TRIPLE, XSD

Triple = tuple[str, str, str, str, str | None, str | None]
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XML = "{http://www.w3.org/XML/1998/namespace}"

_TURTLE = re.compile(
    r'(?P<skip>\s+|#[^\n]*)|(?P<iri><[^<>"{}|^`\\\s]*>)|(?P<long>"""(?:[^"\\]|\\.|"(?!""))*""")|(?P<str>"(?:[^"\\\n]|\\.)*")|(?P<at>@[A-Za-z][\w-]*)|(?P<type>\^\^)'
    r"|(?P<num>[+-]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)|(?P<blank>_:[\w.-]*[\w-])|(?P<name>[A-Za-z_][\w.-]*?(?=:)?:(?:[\w%-]|\.(?=[\w%-]))*|:(?:[\w%-]|\.(?=[\w%-]))*)|(?P<word>[A-Za-z]+)|(?P<op>[][();,.])",
    re.S,
)
_ESCAPE = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


def _unescape(text: str) -> str:
    return re.sub(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _ESCAPE.get(m[3], m[3]), text, flags=re.S)


class Turtle:
    """A recursive-descent reader; text that isn't Turtle raises ValueError."""

    def __init__(self, text: str) -> None:
        self.toks: list[tuple[str, str]] = []
        at = 0
        while at < len(text):
            m = _TURTLE.match(text, at)
            if not m:
                raise ValueError(f"unexpected character {text[at]!r} at {at}")
            if m.lastgroup != "skip":
                self.toks.append((m.lastgroup or "", m.group()))
            at = m.end()
        self.i, self.blanks, self.base = 0, 0, ""
        self.prefixes: dict[str, str] = {}
        self.out: list[Triple] = []

    def peek(self) -> tuple[str, str]:
        return self.toks[self.i] if self.i < len(self.toks) else ("", "")

    def take(self, text: str | None = None) -> tuple[str, str]:
        t = self.peek()
        if not t[0] or (text is not None and t[1] != text):
            raise ValueError(f"expected {text or 'more'}, found {t[1] or 'the end'}")
        self.i += 1
        return t

    def read(self) -> list[Triple]:
        while self.peek()[0]:
            kind, text = self.peek()
            if text.lower() in ("@prefix", "prefix"):
                self.take()
                name = self.take()[1]
                self.prefixes[name.rstrip(":")] = self.take()[1][1:-1]
                if kind == "at":
                    self.take(".")
            elif text.lower() in ("@base", "base"):
                self.take()
                self.base = self.take()[1][1:-1]
                if kind == "at":
                    self.take(".")
            else:
                s = self.node()
                if self.peek()[1] != ".":
                    self.predicates(s[0])
                self.take(".")
        return self.out

    def predicates(self, s: str) -> None:
        while True:
            kind, text = self.peek()
            if kind == "word" and text == "a":
                self.take()
                p = RDF_TYPE
            else:
                p, p_kind, *_ = self.node()
                if p_kind != "iri":
                    raise ValueError(f"{p} can't be a predicate")
            while True:
                self.out.append((s, p, *self.node()))
                if self.peek()[1] != ",":
                    break
                self.take()
            if self.peek()[1] != ";":
                return
            while self.peek()[1] == ";":
                self.take()
            if self.peek()[1] in (".", "]", ""):
                return

    def fresh(self) -> str:
        self.blanks += 1
        return f"_:g{self.blanks}"

    def node(self) -> tuple[str, str, str | None, str | None]:
        kind, text = self.take()
        if kind == "iri":
            iri = _unescape(text[1:-1])
            return (iri if re.match(r"[A-Za-z][\w+.-]*:", iri) else self.base + iri), "iri", None, None
        if kind == "name":
            prefix, _, local = text.partition(":")
            if prefix not in self.prefixes:
                raise ValueError(f"the prefix {prefix}: is unknown")
            return self.prefixes[prefix] + local, "iri", None, None
        if kind == "blank":
            return text, "blank", None, None
        if kind in ("str", "long"):
            value = _unescape(text[3:-3] if kind == "long" else text[1:-1])
            if self.peek()[0] == "at":
                return value, "literal", None, self.take()[1][1:]
            if self.peek()[0] == "type":
                self.take()
                return value, "literal", self.node()[0], None
            return value, "literal", None, None
        if kind == "num":
            return text, "literal", XSD + ("integer" if re.fullmatch(r"[+-]?\d+", text) else "decimal" if "e" not in text.lower() else "double"), None
        if kind == "word" and text in ("true", "false"):
            return text, "literal", XSD + "boolean", None
        if text == "[":
            b = self.fresh()
            if self.peek()[1] != "]":
                self.predicates(b)
            self.take("]")
            return b, "blank", None, None
        if text == "(":
            items = []
            while self.peek()[1] != ")":
                items.append(self.node())
            self.take(")")
            head = (RDF + "nil", "iri", None, None)
            for x in reversed(items):
                b = self.fresh()
                self.out += [(b, RDF + "first", *x), (b, RDF + "rest", *head)]
                head = (b, "blank", None, None)
            return head
        raise ValueError(f"unexpected {text}")


class RdfXml:
    def __init__(self, text: str) -> None:
        self.out: list[Triple] = []
        self.blanks = 0
        root = ET.fromstring(text)
        self.base = root.get(XML + "base", "")
        nodes = list(root) if root.tag == f"{{{RDF}}}RDF" else [root]
        for n in nodes:
            self.node(n, root.get(XML + "lang"))

    @staticmethod
    def iri(tag: str) -> str:
        return tag[1:].replace("}", "", 1) if tag.startswith("{") else tag

    def absolute(self, iri: str) -> str:
        if re.match(r"[A-Za-z][\w+.-]*:", iri):
            return iri
        return self.base.partition("#")[0] + iri if iri.startswith("#") else self.base + iri

    def node(self, e: ET.Element, lang: str | None) -> tuple[str, str]:
        lang = e.get(XML + "lang", lang)
        if f"{{{RDF}}}about" in e.attrib:
            s, kind = self.absolute(e.attrib[f"{{{RDF}}}about"]), "iri"
        elif f"{{{RDF}}}ID" in e.attrib:
            s, kind = self.base.partition("#")[0] + "#" + e.attrib[f"{{{RDF}}}ID"], "iri"
        elif f"{{{RDF}}}nodeID" in e.attrib:
            s, kind = "_:" + e.attrib[f"{{{RDF}}}nodeID"], "blank"
        else:
            self.blanks += 1
            s, kind = f"_:g{self.blanks}", "blank"
        if e.tag != f"{{{RDF}}}Description":
            self.out.append((s, RDF_TYPE, self.iri(e.tag), "iri", None, None))
        for k, v in e.attrib.items():
            if not k.startswith((f"{{{RDF}}}", XML)) and k.startswith("{"):
                self.out.append((s, self.iri(k), v, "literal", None, lang))
        for p in e:
            self.property(s, p, lang)
        return s, kind

    def property(self, s: str, p: ET.Element, lang: str | None) -> None:
        lang = p.get(XML + "lang", lang)
        name, kids = self.iri(p.tag), list(p)
        if f"{{{RDF}}}resource" in p.attrib:
            self.out.append((s, name, self.absolute(p.attrib[f"{{{RDF}}}resource"]), "iri", None, None))
        elif f"{{{RDF}}}nodeID" in p.attrib:
            self.out.append((s, name, "_:" + p.attrib[f"{{{RDF}}}nodeID"], "blank", None, None))
        elif p.get(f"{{{RDF}}}parseType") == "Resource":
            self.blanks += 1
            b = f"_:g{self.blanks}"
            self.out.append((s, name, b, "blank", None, None))
            for k in kids:
                self.property(b, k, lang)
        elif p.get(f"{{{RDF}}}parseType") == "Collection":
            head = (RDF + "nil", "iri")
            for k in reversed(kids):
                self.blanks += 1
                b = f"_:g{self.blanks}"
                self.out += [(b, RDF + "first", *self.node(k, lang), None, None), (b, RDF + "rest", *head, None, None)]
                head = (b, "blank")
            self.out.append((s, name, *head, None, None))
        elif kids:
            for k in kids:
                self.out.append((s, name, *self.node(k, lang), None, None))
        else:
            kind = p.get(f"{{{RDF}}}datatype")
            self.out.append((s, name, p.text or "", "literal", kind, None if kind else lang))


def parse(text: str, form: str = "xml") -> list[Triple]:
    """Triples of a text in xml, turtle or n3 (of which the part that is Turtle)."""
    if form in ("turtle", "ttl", "n3"):
        return Turtle(text).read()
    if form in ("xml", "owl"):
        try:
            return RdfXml(text).out
        except ET.ParseError as e:
            raise ValueError(f"no RDF/XML: {e}") from e
    raise ValueError(f"unknown RDF format {form}")


def form_of(path: str) -> str:
    return {"ttl": "turtle", "n3": "n3"}.get(path.rsplit(".", 1)[-1].lower(), "xml")


def triples_of(texts: DataFrame, form: str | None = None) -> DataFrame:
    """TRIPLE rows, distinct, of texts (path, text); the format is given or comes from the path's ending. A file is a graph of its own, so blank nodes carry its name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, text in zip(b["path"], b["text"], strict=True):
                rows = parse(text, form or form_of(path))
                own = lambda x, path=path: f"{x}@{path}" if x.startswith("_:") else x
                yield pd.DataFrame([(own(s), p, own(o) if kind == "blank" else o, kind, dt, lang) for s, p, o, kind, dt, lang in rows], columns=TRIPLE.names)

    return texts.select("path", "text").mapInPandas(run, TRIPLE).distinct()


def read(spark: SparkSession, path: str, form: str | None = None) -> DataFrame:
    rows = spark.read.text(path, wholetext=True)
    return triples_of(rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")), form)


def n_triples(triples: DataFrame, *keep: str) -> DataFrame:
    """One line per triple, in N-Triples (which Turtle readers read too), beside the columns to keep."""
    quoted = F.concat(F.lit('"'), F.replace(F.replace(F.replace(F.replace(F.col("o"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit('"'))
    tail = F.when(F.col("lang").isNotNull(), F.concat(F.lit("@"), "lang")).when(F.col("datatype").isNotNull(), F.concat(F.lit("^^<"), "datatype", F.lit(">"))).otherwise("")
    ref = lambda c: F.when(F.col(c).startswith("_:"), F.col(c)).otherwise(F.concat(F.lit("<"), c, F.lit(">")))
    obj = F.when(F.col("o_kind") == "literal", F.concat(quoted, tail)).otherwise(ref("o"))
    return triples.select(*keep, F.concat(ref("s"), F.lit(" <"), "p", F.lit("> "), obj, F.lit(" .")).alias("line"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """TRIPLE rows, distinct, of N-Triples: each line is taken apart by itself, by expressions alone, wherever it lies."""
    line = F.trim("value")
    pattern = r"^(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(?:(<[^>]*>|_:\S+)|\"((?:[^\"\\]|\\.)*)\"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?)\s*\.\s*(?:#.*)?$"
    part = lambda k: F.nullif(F.regexp_extract(line, pattern, k), F.lit(""))
    bare = lambda c: F.regexp_replace(c, "^<|>$", "")
    mark = "\u0000"  # stands for a backslash while other escapes are undone
    text = F.regexp_extract(line, pattern, 4)
    for written, meant in (("\\\\", mark), ('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), (mark, "\\")):
        text = F.replace(text, F.lit(written), F.lit(meant))
    ref = part(3)
    kind = F.when(ref.isNull(), "literal").when(ref.startswith("_:"), "blank").otherwise("iri")
    rows = spark.read.text(path).where((line != "") & ~line.startswith("#"))
    checked = F.when(line.rlike(pattern), True).otherwise(F.raise_error(F.concat(F.lit("no N-Triples line: "), line)).cast("boolean"))
    return rows.where(checked).select(bare(part(1)).alias("s"), F.regexp_extract(line, pattern, 2).alias("p"), F.when(ref.isNull(), text).otherwise(bare(ref)).alias("o"), kind.alias("o_kind"), part(6).alias("datatype"), part(5).alias("lang")).distinct()


def write(triples: DataFrame, path: str) -> None:
    n_triples(triples).write.mode("overwrite").text(path)
