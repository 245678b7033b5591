"""Personal data: protected entities by pattern, and the terms that give them away.

*Entities* (base spans) are e-mail addresses, IP addresses, payment cards and
phone numbers; per kind the leftmost matches that do not overlap, kept when
they pass the kind's test.

*Disclosing terms* are found by information theory over the whole corpus.  A
line is a context, and equal lines count once, so copies add nothing.  For an
entity e in at least ``SUPPORT`` contexts and a word t that shares at least
``SUPPORT`` contexts with it, outside every entity,

    PMI(t, e) = log2(N * n(t, e) / (n(t) * n(e))),   IC(e) = log2(N / n(e))

with n counted over the distinct lines of all documents and N their number.
PMI(t, e) / IC(e) is the share of e's information that t alone discloses: 1 if
t never occurs without e.  From ``GENERALISE`` on, t is replaced by its shape
([NAME], [NUMBER], [WORD]) wherever it occurs in the corpus, from ``REMOVE``
on it is removed.

Everything is DataFrame and SQL functions.  Positions come from the pieces
between matches: their lengths in code points add up.

Null and empty texts have no spans; rows are treated one by one, so repeated
rows and null ids change nothing; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C

SUPPORT = 3
GENERALISE = 0.8
REMOVE = 0.95
BROADCAST_BYTES = 16 << 20  # of the terms by text, measured before they are sent to every task

KINDS = ["email", "ip", "card", "phone", "term", "removed"]
BASE = 4  # of these kinds

# The kinds' patterns.  Possessive repetition and the look-behind leave the
# matches as they are and keep long runs linear; \G lets a match begin where
# the last one ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_WORD = r"[\p{L}\p{N}]++"
_SPANS = "array<struct<s:int,e:int,k:int,v:string>>"


def _lit(pattern: str) -> str:
    return "r'" + pattern + "'"


def _find(prefix: str, kind: int) -> Column:
    """Spans of the matches ``<prefix>_m`` that stand between the pieces ``<prefix>_p``."""
    m, p = f"{prefix}_m", f"{prefix}_p"
    return F.expr(f"""
      CASE WHEN size({m}) > 0 THEN aggregate(
        sequence(1, size({m})),
        named_struct('at', 0, 'out', cast(array() AS {_SPANS})),
        (a, i) -> named_struct(
          'at', a.at + length({p}[i - 1]) + length({m}[i - 1]),
          'out', cast(array_append(a.out, named_struct(
              's', a.at + length({p}[i - 1]),
              'e', a.at + length({p}[i - 1]) + length({m}[i - 1]),
              'k', {kind}, 'v', {m}[i - 1])) AS {_SPANS})),
        a -> a.out)
      ELSE cast(array() AS {_SPANS}) END""")


def _passes(kind: str):
    """The kind's test of a span."""
    return lambda x: _test(kind, x["v"])


def _test(kind: str, v: Column) -> Column:
    digits = F.regexp_replace(v, "[^0-9]", "")
    if kind == "ip":
        part = lambda y: F.regexp_replace(y, "^0+(?=.)", "")
        return F.forall(F.split(v, r"\."), lambda y: (F.length(part(y)) <= 3)
                        & (F.substring(part(y), 1, 3).cast("int") <= 255))
    if kind == "card":
        n = F.length(digits)
        luhn = F.aggregate(
            F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0),
            lambda a, i: a + F.when(i % 2 == 1, _digit(digits, n, i)).otherwise(
                F.when(_digit(digits, n, i) > 4, 2 * _digit(digits, n, i) - 9).otherwise(2 * _digit(digits, n, i))))
        return n.between(12, 19) & (luhn % 10 == 0)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _digit(digits: Column, n: Column, i: Column) -> Column:
    """The i-th digit from the right."""
    return F.substring(digits, n - i + 1, F.lit(1)).cast("int")


def with_entities(df: DataFrame, text_col: str, out_col: str = "base") -> DataFrame:
    """Adds the base spans (s, e, k, v), by start and kind.  ``text_col`` must not be null."""
    text = C.col(text_col)
    cheap = {"email": text.contains("@"), "phone": text.contains("+")}
    had = df.columns
    digit = f"{out_col}__digit"
    df = df.withColumn(digit, text.rlike("[0-9]"))
    none = F.expr("cast(array() AS array<string>)")
    for kind, pattern in PATTERNS.items():
        may = cheap.get(kind, F.lit(True)) & (F.col(digit) if kind != "email" else F.lit(True))
        df = df.withColumn(f"{kind}__m", F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    for kind, pattern in PATTERNS.items():
        df = df.withColumn(f"{kind}__p", F.when(F.size(f"{kind}__m") > 0, F.split(text, pattern, -1)).otherwise(none))
    for k, kind in enumerate(PATTERNS):
        df = df.withColumn(f"{kind}__s", _find(f"{kind}_", k))
    for kind in PATTERNS:
        df = df.withColumn(f"{kind}__s", F.filter(f"{kind}__s", _passes(kind)))
    found = F.array_sort(F.concat(*(F.col(f"{kind}__s") for kind in PATTERNS)))
    # an array of (s, e, k, v) sorts by start and end first; kinds come before ends
    found = F.transform(F.array_sort(F.transform(found, lambda x: F.struct(x["s"], x["k"], x["e"], x["v"]))),
                        lambda x: F.struct(x["s"], x["e"], x["k"], x["v"]))
    return df.withColumn(out_col, found).select(*[C.col(c) for c in had], out_col)


def _merged(spans: Column) -> Column:
    """Spans with overlapping ones as one, under the first one's kind."""
    empty = F.expr(f"cast(array() AS {_SPANS})")
    last = lambda a: F.element_at(a, -1)
    return F.aggregate(spans, empty, lambda a, x: F.when(
        (F.size(a) > 0) & (x["s"] < F.coalesce(F.get(a, F.size(a) - 1)["e"], F.lit(-1))),
        F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))),
                 F.array(F.struct(last(a)["s"].alias("s"), F.greatest(last(a)["e"], x["e"]).alias("e"),
                                  last(a)["k"].alias("k"), last(a)["v"].alias("v")))),
    ).otherwise(F.concat(a, F.array(x))).cast(_SPANS))


def replaced(text: Column, spans: Column, label) -> Column:
    """``text`` with every (merged) span replaced; label: a column for a span."""
    n = F.size(spans)
    before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["e"])
    parts = F.transform(spans, lambda x, i: F.concat(F.substring(text, before(i) + 1, x["s"] - before(i)), label(x)))
    tail = F.substring(text, F.get(spans, n - 1)["e"] + 1, F.length(text))
    return F.when(n > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(text)


# --- disclosing terms ----------------------------------------------------------------------

def _words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0)),
                                     lambda w: F.length(w) >= 3))


def disclosing_terms(docs: DataFrame, path: str, support: int = SUPPORT, generalise: float = GENERALISE,
                     remove: float = REMOVE) -> DataFrame | None:
    """(term, share, kind) over all ``docs`` (text, not null), written below ``path``; None if there are none."""
    marked = with_entities(docs, "text").where(F.size("base") > 0)
    lines = marked.select(F.explode(F.split("text", "\n", -1)).alias("line"))
    context = with_entities(lines, "line").where(F.size("base") > 0)
    outside = replaced(F.col("line"), _merged(F.col("base")), lambda x: F.lit(" "))
    key = lambda x: F.concat(x["k"].cast("string"), F.lit(":"), F.when(x["k"] == 0, F.lower(x["v"])).otherwise(
        F.when(x["k"] == 1, x["v"]).otherwise(F.regexp_replace(x["v"], "[^0-9]", ""))))
    context = C.store(
        context.select(F.xxhash64("line").alias("line_key"), F.array_distinct(F.transform("base", key)).alias("entities"),
                       _words(outside).alias("words")).dropDuplicates(["line_key"]),
        f"{path}/contexts")

    pairs = context.select("words", F.explode("entities").alias("entity"))
    often = pairs.groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= support)
    shared = (pairs.join(often, "entity").select("entity", "n_e", F.explode("words").alias("term"))
              .groupBy("entity", "term").agg(F.count("*").alias("n_te"), F.first("n_e").alias("n_e"))
              .where(F.col("n_te") >= support))
    # n(t) is at least what the entities' own contexts show; where that alone rules a term out (as it does for
    # common words), the corpus need not be searched for it
    all_lines = docs.select(F.explode(F.split("text", "\n", -1)).alias("line"))
    total = all_lines.select(F.xxhash64("line").alias("line_key")).distinct().count()
    least = context.select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("least"))
    most = F.col("n_te") * F.pow(F.greatest(F.lit(float(total)) / F.col("n_e"), F.lit(1.0)), F.lit(1 - generalise))
    shared = C.store(shared.join(least, "term").where(F.col("least") <= most * 1.000001), f"{path}/shared")
    if shared.isEmpty():
        return None

    wanted = C.store(shared.select("term").distinct(), f"{path}/wanted")
    # the hash first, so that the text is not carried to every word
    with_term = (all_lines.select(F.xxhash64("line").alias("line_key"), _words(F.col("line")).alias("words"))
                 .select("line_key", F.explode("words").alias("term"))
                 .join(wanted, "term").distinct().groupBy("term").agg(F.count("*").alias("n_t")))
    pmi = F.log2(F.lit(float(total)) * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    share = F.when(F.col("n_e") < total, pmi / F.log2(F.lit(float(total)) / F.col("n_e"))).otherwise(F.lit(0.0))
    found = (shared.join(with_term, "term").withColumn("share", share).groupBy("term")
             .agg(F.max("share").alias("share")).where(F.col("share") >= generalise)
             .withColumn("kind", F.when(F.col("share") >= remove, KINDS.index("removed")).otherwise(KINDS.index("term"))))
    found = C.store(found, f"{path}/terms")
    return None if found.isEmpty() else found


def with_spans(docs: DataFrame, text_col: str = "text", support: int = SUPPORT, generalise: float = GENERALISE,
               remove: float = REMOVE) -> DataFrame:
    """The rows with ``pii_base`` and ``pii_spans``: arrays of (s, e, k, v); positions in code points, end exclusive.

    k numbers ``KINDS``.  ``pii_spans`` holds the base spans and those of
    disclosing terms that touch no base span.
    """
    spark = docs.sparkSession
    path = C.work_dir(spark, "pii")
    text = F.coalesce(C.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(text.alias("text"))
    terms = disclosing_terms(plain, path, support, generalise, remove)
    out = with_entities(docs.withColumn("pii_text", text), "pii_text", "pii_base")
    if terms is None:
        return out.withColumn("pii_spans", F.col("pii_base")).drop("pii_text")

    # which terms a text holds, by the text's hash and length; only texts with a term are kept
    ident = [F.xxhash64("text").alias("pii_key"), F.length("text").alias("pii_length")]
    held = (plain.select(*ident, _words(F.col("text")).alias("words"))
            .select("pii_key", "pii_length", F.explode("words").alias("term")).join(terms, "term").distinct()
            .groupBy("pii_key", "pii_length")
            .agg(F.sort_array(F.collect_list(F.struct("term", "kind"))).alias("pii_terms")))
    held = C.store(held, f"{path}/held")
    size = held.agg(F.sum(F.aggregate("pii_terms", F.lit(64), lambda a, t: a + F.octet_length(t["term"]) + 32))).first()[0] or 0
    if size <= BROADCAST_BYTES:  # else the texts are shuffled once
        held = F.broadcast(held)
    out = (out.withColumn("pii_key", F.xxhash64("pii_text")).withColumn("pii_length", F.length("pii_text"))
           .join(held, ["pii_key", "pii_length"], "left"))
    none = F.expr("cast(array() AS array<string>)")
    some = F.col("pii_terms").isNotNull()
    # letters and digits need no quoting
    any_term = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"),
                        F.array_join(F.transform("pii_terms", lambda t: t["term"]), "|"),
                        F.lit(r")(?![\p{L}\p{N}])"))
    out = out.withColumn("pii_pattern", F.when(some, any_term))
    out = out.withColumn("pii_m", F.when(some, F.regexp_extract_all("pii_text", F.col("pii_pattern"), F.lit(0))).otherwise(none))
    out = out.withColumn("pii_p", F.when(some, F.split("pii_text", F.col("pii_pattern"), F.lit(-1))).otherwise(none))
    out = out.withColumn("pii_found", _find("pii", KINDS.index("term")))
    kind = lambda x: F.element_at(F.map_from_entries("pii_terms"), F.lower(x["v"]))
    apart = F.filter("pii_found", lambda x: ~F.exists("pii_base", lambda y: (x["s"] < y["e"]) & (y["s"] < x["e"])))
    apart = F.transform(apart, lambda x: F.struct(
        x["s"].alias("s"), F.coalesce(kind(x), F.lit(KINDS.index("term"))).alias("k"), x["e"].alias("e"), x["v"].alias("v")))
    base = F.transform("pii_base", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), x["v"].alias("v")))
    both = F.transform(F.array_sort(F.concat(base, apart)), lambda x: F.struct(x["s"], x["e"], x["k"], x["v"]))
    return (out.withColumn("pii_spans", F.when(some, both.cast(_SPANS)).otherwise(F.col("pii_base")))
            .drop("pii_text", "pii_key", "pii_length", "pii_terms", "pii_pattern", "pii_m", "pii_p", "pii_found"))


def _name(k: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), k + 1)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", _name(x["k"]), x["s"], x["e"])), ",")


def _label(x: Column) -> Column:
    shape = (F.when(x["v"].rlike("[0-9]"), "[NUMBER]").when(x["v"].rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]"))
    return (F.when(x["k"] < BASE, F.concat(F.lit("["), F.upper(_name(x["k"])), F.lit("]")))
            .when(x["k"] == KINDS.index("term"), shape).otherwise(""))


def sanitised(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The rows with every span of ``text_col`` replaced; all columns stay, a null text too."""
    own = docs.select(F.struct(*[C.col(c) for c in docs.columns]).alias("row"), C.col(text_col).cast("string").alias("text"))
    merged = with_spans(own, "text", **limits).withColumn("pii_merged", _merged(F.col("pii_spans")))
    new = replaced(F.col("text"), F.col("pii_merged"), _label)
    return merged.select(*[(new if c == text_col else F.col("row")[c]).alias(c)
                           for c in docs.columns])


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """doc_id, a count per base kind, base_sha256 of the listed base spans, and all spans listed."""
    rows = with_spans(docs.select(C.col(id_col).alias("doc_id"), C.col(text_col).alias("text")), "text", **limits)
    of_kind = lambda k: lambda x: x["k"] == k
    counts = [F.size(F.filter("pii_base", of_kind(k))).cast("long").alias(f"n_{kind}")
              for k, kind in enumerate(KINDS[:BASE])]
    return rows.select("doc_id", *counts, F.sha2(listed(F.col("pii_base")), 256).alias("base_sha256"),
                       listed(F.col("pii_spans")).alias("spans"))
