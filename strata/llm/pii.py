"""Personal data: base patterns, then bootstrapped contextual extraction.

Base entities (e-mail, IP address, card, phone) are found by fixed patterns, leftmost and
not overlapping per kind. They are seeds of a graph of lexical patterns and instances; keys
written as ``SECRET_DIGITS`` or more hexadecimal digits are seeds of a fifth kind, secret, which has no
base spans. A pattern is a context: the one or two words before an instance, the word after it,
the words round it, or the label before ``=`` or ``:``. An instance is the identifier's own
text. Candidates are all other identifier-like texts: whole runs of digit groups (joined by
a space, hyphen, dot or parentheses, so a number written in groups is one candidate), and
chunks with ``@`` or with letters and digits; both with ``MIN_DIGITS`` digits or ``@``.

Spark scores the graph in ``ROUNDS`` rounds: a pattern's score for a kind is the lower
confidence bound of the mean score of its distinct instances, a candidate's score that of its
best pattern. Candidates in a pattern with a score of ``CONFIDENT`` or more become spans of
that kind; so do secret seeds, which are never spans by their looks alone. Distinct instances
count once, so copies of a text lend a pattern no weight, and a context that goes with
anything scores low.

Null and empty texts have no spans. Texts are scanned whole, in linear time, and a context
word counts whole however long it is (beyond ``LONG_WORD`` code points by its hash). Of several trusted patterns the
highest score decides, ties by the kind listed first. Null ids and repeated rows are documents
like any other. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Scratch, documents, small, texts

#: The kinds of base spans, and the one that only contexts find.
KINDS = ("email", "ip", "card", "phone")
SECRET, SECRET_DIGITS = 4, 32
LONG_WORD = 64
ROUNDS, CONFIDENT, MIN_SUPPORT, MIN_DIGITS, Z = 3, 0.7, 5, 4, 1.64
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_CHUNK = re.compile(r"[^\x20\x09-\x0D]+")
#: Digit groups joined by one space, hyphen or dot, or by parentheses.
_RUN = re.compile(r"(?<![A-Za-z0-9_@.+-])[+(]?[0-9]++(?:(?:\)[\x20.-]?|[\x20.-]?\(|[\x20.-])[0-9]++)*+"
                  r"(?![A-Za-z0-9_@])")
_HEX = re.compile(r"(?=[0-9]*[A-Fa-f])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{%d,}" % SECRET_DIGITS)
_LABEL = re.compile(r"[^\x20\x09-\x0D\"'`(\[{<:=]+$")
_TRIM = "\"'`.,;:!?()[]{}<>#*$%&|"
_OPEN = "\"'`([{<"
_SPACE = " \t\n\v\f\r"


def _emails(text: str) -> list[tuple[int, int]]:
    """As the pattern would match, without its retries: each local part is walked once."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [(0, a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255
               for part in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def _word(word: str) -> str:
    """A context word as part of a pattern; a very long one by its hash, which tells it apart."""
    if len(word) <= LONG_WORD:
        return word
    return "#" + hashlib.sha256(word.encode("utf-8", "surrogatepass")).hexdigest()


def _back(text: str, end: int) -> int:
    """Where the run of code points that are not space, and that ends at ``end``, begins."""
    while end and text[end - 1] not in _SPACE:
        end -= 1
    return end


def _gap(text: str, end: int) -> int:
    """``end`` without the space before it."""
    while end and text[end - 1] in _SPACE:
        end -= 1
    return end


def _near(text: str, start: int, end: int) -> list[str]:
    """The patterns of a span, in lower case: the words before it (what is glued to it is one),
    the word after it, the words round it, and the label before ``=`` or ``:``."""
    first = _back(text, start)
    if first == start:
        stop = _gap(text, start)
        first = _back(text, stop)
        a = _word(text[first:stop].lower()) if stop else "^"
    else:
        a = _word(text[first:start].lower()) + "_"
    stop = _gap(text, first)
    b = _word(text[_back(text, stop):stop].lower()) if stop else "^"
    m = _CHUNK.search(text, end)
    if m and m.start() == end and not m.group().strip(_TRIM):  # a closing mark
        m = _CHUNK.search(text, m.end())
    c = _word(m.group().strip(_TRIM).lower()) if m else "$"
    out = [f"L {a}", f"LL {b} {a}"]
    if c:
        out += [f"R {c}", f"LR {a} {c}"]
    at = start
    while at and text[at - 1] in _OPEN:
        at -= 1
    at = _gap(text, at)
    if at and text[at - 1] in "=:":
        stop = _gap(text, at - 1)
        m = _LABEL.search(text[_back(text, stop):stop])
        if m:
            out.append(f"A {_word(m.group().lower())}")
    return out


def _found_in(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """The candidates of ``text[a:b]``: runs of digit groups, then other chunks between them."""
    out, at = [], a
    for m in _RUN.finditer(text, a, b):
        if b < len(text) and m.end() == b and text[b] in _LOCAL:
            continue  # goes on in a base entity
        out += _chunks(text, at, m.start())
        if len(_DIGIT.findall(m.group())) >= MIN_DIGITS:
            out.append(m.span())
        at = m.end()
    return out + _chunks(text, at, b)


def _chunks(text: str, a: int, b: int) -> list[tuple[int, int]]:
    out = []
    for m in _CHUNK.finditer(text, a, b):
        chunk = m.group()
        if "@" not in chunk and len(_DIGIT.findall(chunk)) < MIN_DIGITS:
            continue
        label = max(chunk.rfind("="), chunk.rfind(":")) + 1  # in key=value the value counts
        if not any(c.isalnum() for c in chunk[label:]):
            label = 0
        start = m.start() + len(chunk) - len(chunk[label:].lstrip(_TRIM))
        stop = m.end() - (len(chunk) - len(chunk.rstrip(_TRIM)))
        if start < stop and ("@" in text[start:stop]
                             or len(_DIGIT.findall(text[start:stop])) >= MIN_DIGITS):
            out.append((start, stop))
    return out


def _candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Identifier-like texts outside the base spans."""
    out, at = [], 0
    for a, b in sorted((a, b) for _, a, b in spans):
        if at < a:
            out += _found_in(text, at, a)
        at = max(at, b)
    return out + _found_in(text, at, len(text))


_FOUND = ("rid long, doc_id string, base array<struct<kind:int,s:long,e:long>>, "
          "ents array<struct<kind:int,s:long,e:long,inst:string,pats:array<string>>>")
_ARROW = pa.schema([
    ("rid", pa.int64()), ("doc_id", pa.string()),
    ("base", pa.list_(pa.struct([("kind", pa.int32()), ("s", pa.int64()), ("e", pa.int64())]))),
    ("ents", pa.list_(pa.struct([
        ("kind", pa.int32()), ("s", pa.int64()), ("e", pa.int64()), ("inst", pa.string()),
        ("pats", pa.list_(pa.string()))])))])


def _scan(batches):
    for batch, bodies in texts(batches, "text"):
        out = []
        for rid, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                  bodies):
            spans = base_spans(text)
            ents = [(k, a, b) for k, a, b in spans]
            if "@" in text or _DIGIT.search(text):
                ents += [(SECRET if _HEX.fullmatch(text, a, b) else -1, a, b)
                         for a, b in _candidates(text, spans)]
            out.append({"rid": rid, "doc_id": doc,
                        "base": [{"kind": k, "s": a, "e": b} for k, a, b in spans],
                        "ents": [{"kind": k, "s": a, "e": b, "inst": text[a:b].lower(),
                                  "pats": _near(text, a, b)} for k, a, b in ents]})
        yield pa.RecordBatch.from_pylist(out, schema=_ARROW)


def _bound(mean, n):
    """Lower end of Wilson's interval for a mean score of ``n`` instances."""
    z2 = Z * Z
    return ((mean + z2 / (2 * n) - Z * F.sqrt((mean * (1 - mean) + z2 / (4 * n)) / n))
            / (1 + z2 / n))


def confident_patterns(scratch: Scratch, ents: DataFrame) -> DataFrame:
    """(pattern, kind, score) of the trusted patterns of ``ents`` (kind, inst, pats)."""
    edges = scratch.stage(ents.select("kind", "inst", F.explode("pats").alias("pattern"))
                          .distinct(), "edges")
    support = (edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"),
                                            F.max("kind").alias("seeded"))
               .filter((F.col("n") >= MIN_SUPPORT) & (F.col("seeded") >= 0)))
    support = scratch.stage(support.select("pattern", "n"), "support")
    seeds = edges.filter("kind >= 0").select("inst", "kind", "pattern", F.lit(1.0).alias("r"))
    unknown = edges.filter("kind < 0").select("inst", "pattern")
    score = None
    for _ in range(ROUNDS):
        parts = seeds
        if score is not None:
            guess = (unknown.join(small(score), "pattern").groupBy("inst", "kind")
                     .agg(F.max("score").alias("r")))
            parts = seeds.unionByName(unknown.join(guess, "inst")
                                      .select("inst", "kind", "pattern", "r"))
        score = scratch.stage(
            parts.groupBy("pattern", "kind").agg(F.sum("r").alias("r"))
            .join(small(support), "pattern")
            .select("pattern", "kind", _bound(F.least(F.col("r") / F.col("n"), F.lit(1.0)),
                                              F.col("n")).alias("score"))
            .filter(F.col("score") >= CONFIDENT / 2), "scores")
    return score.filter(F.col("score") >= CONFIDENT)


def _text_of(spans):
    names = F.array(*map(F.lit, (*KINDS, "secret")))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", names[x["kind"]], x["s"], x["e"])), ",")


def find_pii(spark: SparkSession, df: DataFrame, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, counts of base spans, base_sha256, spans, n_added
    (spans that contexts found), n_spans (all) and flagged (whether there are any)."""
    scratch = Scratch(spark, "pii")
    found = scratch.stage(
        df.select(F.monotonically_increasing_id().alias("rid"),
                  F.col(id_col).cast("string").alias("doc_id"),
                  F.col(text_col).cast("string").alias("text")).mapInArrow(_scan, _FOUND), "found")
    ents = found.select("rid", F.explode("ents").alias("x")).select("rid", "x.*")
    trusted = confident_patterns(scratch, ents)
    added = (ents.filter(f"kind < 0 or kind = {SECRET}").select("rid", "s", "e", F.explode("pats").alias("pattern"))
             .join(small(trusted), "pattern").groupBy("rid", "s", "e")
             .agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("m"))
             .groupBy("rid").agg(F.collect_list(F.struct(
                 (-F.col("m.k")).alias("kind"), "s", "e")).alias("more")))
    added = scratch.stage(added, "added")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    id_type = df.schema[id_col].dataType
    more = F.coalesce("more", F.array().cast("array<struct<kind:int,s:bigint,e:bigint>>"))
    return found.select("rid", "doc_id", "base").join(small(added), "rid", "left").select(
        F.col("doc_id").cast(id_type).alias("doc_id"),
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_text_of(F.col("base")), 256).alias("base_sha256"),
        _text_of(F.concat("base", more)).alias("spans"),
        F.size(more).cast("long").alias("n_added"),
        (F.size("base") + F.size(more)).cast("long").alias("n_spans"),
        (F.size("base") + F.size(more) > 0).alias("flagged"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(spark, documents(spark, sf_dir))
