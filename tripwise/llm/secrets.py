r"""Secret scans with multipart credential linking, in DataFrame operations only.

Base kinds are what a pattern alone proves: ``assign`` (a keyword, ``:`` or ``=`` and a
value), ``access`` (an access-key id) and ``hex`` (a long hexadecimal run).  Weak kinds
are parts of a credential that mean nothing alone: ``keyid`` (a user or client
name given to a login key), ``blob`` (a long mixed token) and ``endpoint`` (a service
address).  Parts fall into three classes: identifiers (access, keyid), secrets
(assign, hex, blob) and endpoints.  A weak part is reported only if its complements lie
within its scope, ``scope`` code points to either side: an identifier needs a secret
and an endpoint, a blob needs an identifier, an endpoint needs an identifier and a secret.
A weak part that overlaps a base span is not reported again.

Plan.  One scan cuts each text at its matches: the lengths of the matches and of the
gaps between them give every position by a running sum over the exploded matches, so
only lengths are shuffled, never texts.  Scopes of a class are merged into disjoint
intervals; intervals and weak parts meet by an equi-join on (document, stretch of
1,024 code points) with the overlap as its condition.  Merged intervals meet a part
once, so the join's output grows with the parts, not with their pairs.

Defined cases: null text counts as empty; positions are code points, end exclusive;
documents are told apart by two hashes of doc_id and text, so repeated rows get
the same result each and a null doc_id works; a text of any length is scanned whole;
an empty table gives an empty table; ``scan`` reads doc_id and text only, ``redact`` keeps all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripwise.llm.common import fresh, written

KINDS = ("assign", "access", "hex", "keyid", "blob", "endpoint")
#: The three base patterns; group of the value and its least length.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the runs of 24 or more: a run is maximal, so a shorter one never hides a longer
MIN_ASSIGN, MIN_ACCESS = 6, 20
#: Weak patterns.
KEYID = r"""\b(?i:user(?:name)?|login|client_?id|key_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
BLOB = (r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[a-z])(?=[A-Za-z0-9+/_-]*[A-Z])"
        r"[A-Za-z0-9+/_-]{20,}={0,2}")
ENDPOINT = (r"\b(?:https?|ftp|ssh|jdbc|mongodb|mysql|postgres(?:ql)?|redis|amqp)://[^\s\"'<>]+"
            r"|\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?\b")
SCOPE, STRETCH = 200, 1024
#: Bits of the classes that a part needs in its scope; TAKEN marks base spans.
ID, SECRET, END, TAKEN = 1, 2, 4, 8
CLASS = {0: SECRET, 1: ID, 2: SECRET, 3: ID, 4: SECRET, 5: END}
NEEDS = {3: SECRET | END, 4: ID, 5: ID | SECRET}
KEY = ["h1", "h2"]


def _cut(text: Column, kind: int, pattern: str, value: int | None = None) -> Column:
    """Matches as an array of (kind, i, gap before, length, length of the value)."""
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = whole if value is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    return F.transform(F.arrays_zip(F.slice(gaps, F.lit(1), F.size(whole)).alias("g"), whole.alias("w"), values.alias("v")),
                       lambda m, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(m["g"]).alias("gap"),
                                             F.length(m["w"]).alias("len"), F.length(m["v"]).alias("value")))


def _parts(text: Column) -> Column:
    """All candidate parts of a text; weak ones only where the text has an identifier at all."""
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,len:int,value:int>>")

    def where(has: Column, found: list[Column]) -> Column:
        return F.when(has, F.concat(*found)).otherwise(none)

    return F.concat(
        where(text.rlike("(?i)passw|secret|token|api_?key"), [_cut(text, 0, ASSIGN, 2)]),
        where(text.contains("AKIA"), [_cut(text, 1, ACCESS)]),
        where(text.rlike(HEX), [_cut(text, 2, HEX)]),
        where(text.contains("AKIA") | text.rlike(KEYID), [_cut(text, 3, KEYID), _cut(text, 4, BLOB), _cut(text, 5, ENDPOINT)]))


def _keyed(docs: DataFrame, names: list[str] = KEY) -> DataFrame:
    doc, text = F.col("doc_id"), F.coalesce("text", F.lit(""))
    return docs.withColumns(dict(zip(names, (F.xxhash64(doc, text), F.xxhash64(text, F.lit("second"), doc)))))


def _merged(spans: DataFrame, by: list[str]) -> DataFrame:
    """Disjoint unions (lo, hi) of overlapping or touching intervals of each group."""
    w = W.partitionBy(*by).orderBy("lo", "hi")
    before = F.max("hi").over(w.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.when(before.isNull() | (F.col("lo") > before), 1).otherwise(0)
    return spans.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(w)) \
        .groupBy(*by, "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("island")


def _stretches(lo: Column, hi: Column) -> Column:
    return F.explode(F.sequence(F.floor(lo / STRETCH), F.floor((hi - 1) / STRETCH)))


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak ones of ``parts`` (key, kind, start, end) whose complements lie in their scope."""
    kind = F.col("kind")
    of = F.create_map(*[F.lit(x) for kv in CLASS.items() for x in kv])[kind]
    wide = parts.select(*KEY, of.alias("class"), F.greatest(F.col("start") - scope, F.lit(0)).alias("lo"),
                        (F.col("end") + scope).alias("hi"))
    taken = parts.filter(kind <= 2).select(*KEY, F.lit(TAKEN).alias("class"), F.col("start").alias("lo"), F.col("end").alias("hi"))
    scopes = _merged(wide.union(taken), [*KEY, "class"]).withColumn("stretch", _stretches(F.col("lo"), F.col("hi")))
    weak = parts.filter(kind > 2).withColumn("stretch", _stretches(F.col("start"), F.col("end")))
    met = weak.join(scopes, [*KEY, "stretch"]).filter("lo < end and hi > start")
    needs = F.create_map(*[F.lit(x) for kv in NEEDS.items() for x in kv])[kind]
    return met.groupBy(*KEY, "kind", "start", "end").agg(F.bit_or("class").alias("near")) \
        .filter((F.col("near").bitwiseAND(F.lit(TAKEN)) == 0) & (F.col("near").bitwiseAND(needs) == needs)).drop("near")


def spans(docs: DataFrame, scope: int = SCOPE) -> tuple[DataFrame, DataFrame]:
    """The documents with their keys and candidate parts, and all spans (key, kind, start, end) found."""
    text = F.coalesce("text", F.lit(""))
    cut = _keyed(docs.select("doc_id", "text")).select("doc_id", *KEY, _parts(text).alias("parts"))
    cut = written(cut, "parts")
    each = cut.filter(F.size("parts") > 0).dropDuplicates(KEY).select(*KEY, F.explode("parts").alias("p")).select(*KEY, "p.*")
    upto = F.sum(F.col("gap") + F.col("len")).over(W.partitionBy(*KEY, "kind").orderBy("i"))
    parts = each.withColumn("end", upto).filter(
        ((F.col("kind") != 0) | (F.col("value") >= MIN_ASSIGN)) & ((F.col("kind") != 1) | (F.col("value") >= MIN_ACCESS)))
    parts = written(parts.select(*KEY, "kind", (F.col("end") - F.col("len")).alias("start"), "end"), "spans")
    return cut, parts.filter("kind <= 2").unionByName(linked(parts, scope))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, and all spans as text."""
    cut, found = spans(docs, scope)
    def text(spans: Column) -> Column:
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    span = F.struct("start", "kind", "end")
    held = found.groupBy(*KEY).agg(
        *[F.count_if(F.col("kind") == i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
        text(F.collect_list(F.when(F.col("kind") <= 2, span))).alias("base"), text(F.collect_list(span)).alias("spans"))
    out = cut.select("doc_id", *KEY).join(held, KEY, "left")
    return out.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS[:3]],
                      F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def redact(docs: DataFrame, scope: int = SCOPE, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mask`` (``n_chars`` follows where it is a column).

    Only texts with a candidate part are joined with their spans; the others pass as they are.
    """
    _, found = spans(docs, scope)
    *key, at = fresh(docs, "__h1", "__h2", "__holes")
    holes = _merged(found.select(*KEY, F.col("start").alias("lo"), F.col("end").alias("hi")), KEY) \
        .groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("holes")) \
        .select(*[F.col(c).alias(k) for c, k in zip(KEY, key)], F.col("holes").alias(at))
    text = F.col("text")
    has = F.size(_parts(F.coalesce(text, F.lit("")))) > 0
    n = F.size(at)
    kept = F.transform(at, lambda h, i: F.substring(
        text, F.when(i == 0, F.lit(1)).otherwise(F.element_at(at, F.greatest(i, F.lit(1)))["hi"].cast("int") + 1),
        (h["lo"] - F.when(i == 0, F.lit(0).cast("long")).otherwise(F.element_at(at, F.greatest(i, F.lit(1)))["hi"])).cast("int")))
    rest = F.substring(text, F.element_at(at, -1)["hi"].cast("int") + 1, F.length(text))
    hit = _keyed(docs.filter(has), key).join(holes, key, "left") \
        .withColumn("text", F.when(n > 0, F.concat(F.array_join(kept, mask), F.lit(mask), rest)).otherwise(text))
    if "n_chars" in docs.columns:
        hit = hit.withColumn("n_chars", F.when(n > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return docs.filter(~has).unionByName(hit.select(*docs.columns))
