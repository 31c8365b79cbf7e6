"""Secret scans in DataFrame functions only.

Three fixed patterns (assignments, access keys, long hex) give the base spans.
The entropy method adds spans: candidates are runs of ``CANDIDATE`` characters
that hold a letter and a digit; over each a window of ``WINDOW`` characters
slides, and the Shannon entropy of the window is kept up by incremental
counts: one character enters, one leaves, and only their two counts and terms of
``sum(c * log2 c)`` change. A candidate is a secret where some window reaches the
threshold of its character class (hex, or the larger alphabet), unless the allow-list
(placeholders, dates and numbers, UUIDs, paths of plain words) suppresses it or a
base span holds it already.

A placeholder word suppresses what it names: a run is cut at the parts (between / = _ -)
that are placeholders, and each stretch between them is judged as a candidate, so a key
beside "test_" or in a path with "/example/" is found.

Places come from ``split``: the text between the matches and the matches
themselves, added up, are the offsets in code points. Sums over arrays are taken in blocks
of ``BLOCK`` entries, then over the blocks, so texts with very many matches don't copy
ever longer arrays. No pattern repeats a group without bound (Java would recurse).

Edges: a null text has no spans and stays null; empty texts have none; rows
are judged one by one, so ties and repeated rows stay; extra columns pass
through ``redact``; an empty table gives no rows. Whole texts are scanned,
however long.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.once import once

# Fixed patterns.
ASSIGN = (r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
          r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the runs of 24 or more: just those matches of [0-9a-f]+
MIN_ASSIGN, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "entropy")

SHORTEST = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Bits a character; a window of 20 different characters has 4.32.
HEX_BITS, ALPHABET_BITS = 3.0, 3.8
# The allow-list: parts that are placeholders, and shapes of whole candidates.
SEPARATOR = "[/=_-]"
PLACEHOLDER = "^(example|sample|dummy|placeholder|changeme|x{4,})$"
PREFIXES = ("your", "test")  # placeholders before _ or -
NUMBERS = "^[0-9+/_=-]+$"  # dates and numbers
UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
WORDS = "^[A-Za-z][A-Za-z/_-]*[0-9]{0,4}$"  # words, paths of words; separators stand alone in them
TWO_SEPARATORS = "[/_-][/_-]"

BLOCK = 256
#: c * log2 c in units of 2^-32, so that sums don't depend on their order.
_UNIT = 1 << 32
_TERMS = [0, *(round(c * math.log2(c) * _UNIT) for c in range(1, WINDOW + 1))]
_FIRST, _PER_LONG, _BITS = ord("+"), 12, 5  # counts up to 31, twelve to a long, by character from '+' to 'z'
_LONGS = (ord("z") - _FIRST) // _PER_LONG + 1


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _with_running(df: DataFrame, name: str, values: Column, largest: bool = False) -> DataFrame:
    """Adds ``name``: for each of some arrays of numbers (``values``), the sums of the entries before each entry, or the largest of them (none: 0)."""
    both = (lambda x, y: F.greatest(x, y)) if largest else (lambda x, y: x + y)
    start = F.struct(_empty("int").alias("out"), F.lit(0).alias("at"))

    def fold(array: Column, value) -> Column:
        return F.aggregate(array, start, lambda a, x: F.struct(F.concat(a["out"], F.array(a["at"])).alias("out"), both(a["at"], value(x)).alias("at")))

    block = lambda v, k: fold(F.slice(v, k * BLOCK + 1, BLOCK), lambda x: x)
    cut = lambda v: F.when(F.size(v) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda k: block(v, k))).otherwise(
        _empty("struct<out:array<int>,at:int>"))
    df = once(df, __values=values)
    df = once(df, __blocks=F.transform("__values", cut))
    df = once(df, __offsets=F.transform("__blocks", lambda blocks: fold(blocks, lambda b: b["at"])["out"]))
    whole = F.zip_with("__blocks", "__offsets", lambda blocks, offsets: F.flatten(F.zip_with(blocks, offsets, lambda b, o: F.transform(b["out"], lambda x: both(x, o)))))
    return once(df, **{name: whole}).drop("__values", "__blocks", "__offsets")


def _with_matches(df: DataFrame, **patterns: str) -> DataFrame:
    """Adds an array of (match, start) in order for each pattern; texts without a match cost one search."""
    found = {f"{n}_m": F.when(F.col("__text").rlike(p), F.regexp_extract_all("__text", F.lit(p), F.lit(0))).otherwise(_empty("string")) for n, p in patterns.items()}
    df = once(df, **found)
    lengths = {f"{n}_b": F.when(F.size(f"{n}_m") > 0, F.transform(F.split("__text", p, -1), lambda s: F.length(s))).otherwise(_empty("int")) for n, p in patterns.items()}
    df = once(df, **lengths)
    between = {n: F.slice(f"{n}_b", 1, F.size(f"{n}_m")) for n in patterns}
    df = _with_running(df, "__before", F.array(*[F.zip_with(between[n], f"{n}_m", lambda b, m: b + F.length(m)) for n in patterns]))
    placed = {n: F.zip_with(f"{n}_m", F.zip_with(F.get("__before", F.lit(i)), between[n], lambda x, b: x + b), lambda m, at: F.struct(m.alias("match"), at.alias("start"))) for i, n in enumerate(patterns)}
    return once(df, **placed).drop(*found, *lengths, "__before")


def _masked(run: Column) -> Column:
    """The run with its placeholder parts blank."""
    parts, separators = F.split(run, SEPARATOR, -1), F.concat(F.regexp_extract_all(run, F.lit(SEPARATOR), F.lit(0)), F.array(F.lit("")))
    named = lambda p, s: F.lower(p).rlike(PLACEHOLDER) | (F.lower(p).isin(*PREFIXES) & s.isin("_", "-"))
    return F.array_join(F.zip_with(parts, separators, lambda p, s: F.concat(F.when(named(p, s), F.repeat(F.lit(" "), F.length(p))).otherwise(p), s)), "")


def _with_stretches(df: DataFrame) -> DataFrame:
    """``__runs`` cut at their placeholder parts: the stretches that are long enough."""
    words = "|".join([PLACEHOLDER.strip("^()$"), *PREFIXES])
    pieces = F.transform("__runs", lambda r: F.when(r["match"].rlike(f"(?i){words}"), F.split(_masked(r["match"]), " ")).otherwise(F.array(r["match"])))
    df = once(df, __pieces=pieces)
    df = _with_running(df, "__at", F.transform("__pieces", lambda ps: F.transform(ps, lambda p: F.length(p) + 1)))

    def cut(run: Column, ps: Column, at: Column) -> Column:
        # separators next to a placeholder go with it
        def piece(p: Column, x: Column) -> Column:
            last = x + F.length(p) >= F.length(run["match"])
            front = F.when(x > 0, F.length(p) - F.length(F.ltrim(p, F.lit("/=_-")))).otherwise(0)
            kept = F.when(x > 0, F.ltrim(p, F.lit("/=_-"))).otherwise(p)
            return F.struct(F.when(last, kept).otherwise(F.rtrim(kept, F.lit("/=_-"))).alias("match"), (run["start"] + x + front).alias("start"))
        return F.zip_with(ps, at, piece)

    both = F.zip_with("__pieces", "__at", lambda ps, at: F.struct(ps.alias("ps"), at.alias("at")))
    stretches = F.flatten(F.zip_with("__runs", both, lambda r, x: cut(r, x["ps"], x["at"])))
    df = once(df, __cut=F.when(F.size("__runs") > 0, stretches).otherwise(_empty("struct<match:string,start:int>")))
    return df.drop("__runs", "__pieces", "__at").withColumn("__runs", F.filter("__cut", lambda m: F.length(m["match"]) >= SHORTEST)).drop("__cut")


def _allowed(match: Column) -> Column:
    return match.rlike(NUMBERS) | match.rlike(UUID) | (match.rlike(WORDS) & ~match.rlike(TWO_SEPARATORS))


def _window_bits(run: Column) -> Column:
    """The highest entropy of a window of the run, by incremental counts.

    The state holds the counts of the window's characters, ``sum(c log2 c)``
    and the least of the sums so far. A window of w characters has entropy
    ``log2 w - sum(c log2 c) / w``.
    """
    more = F.array(*[F.lit(_TERMS[c + 1] - _TERMS[c]).cast("long") for c in range(WINDOW)])  # what one more adds to a count's term
    place = F.transform(F.split(run, ""), lambda c: F.ascii(c) - _FIRST)
    enters = F.transform(place, lambda i: F.struct(F.floor(i / _PER_LONG).cast("int").alias("at"), (i % _PER_LONG * _BITS).alias("shift")))
    none = F.struct(F.lit(-1).alias("at"), F.lit(0).alias("shift"))
    one = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x)
    count = lambda n, x: F.call_function("shiftright", F.get(n, x["at"]), x["shift"]).bitwiseAND(F.lit(31).cast("long")).cast("int")
    moves = F.zip_with(enters, F.slice(F.concat(F.array_repeat(none, WINDOW), enters), 1, F.length(run)),
                       lambda e, x: F.struct(e.alias("in"), x.alias("out"), one(e["shift"]).alias("plus"), one(x["shift"]).alias("minus")))
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), _LONGS).alias("n"), F.lit(0).cast("long").alias("sum"), F.lit(2**62).alias("least"))

    def step(a: Column, m: Column) -> Column:
        full = m["out"]["at"] >= 0
        counts = F.transform(a["n"], lambda c, i: c + F.when(i == m["in"]["at"], m["plus"]).otherwise(F.lit(0)) - F.when(i == m["out"]["at"], m["minus"]).otherwise(F.lit(0)))
        change = F.get(more, count(a["n"], m["in"])) - F.when(full, F.get(more, count(a["n"], m["out"]) - 1)).otherwise(F.lit(0))
        total = F.when(m["in"] == m["out"], a["sum"]).otherwise(a["sum"] + change)
        return F.struct(counts.alias("n"), total.alias("sum"), F.when(full, F.least(a["least"], a["sum"])).otherwise(a["least"]).alias("least"))

    least = F.aggregate(moves, start, step, lambda a: F.least(a["least"], a["sum"]))
    return F.lit(math.log2(WINDOW)) - least / F.lit(float(_UNIT * WINDOW))


def spans(docs: DataFrame) -> DataFrame:
    """``docs`` (with text) and ``__base``, ``__spans``: arrays of (start, kind, end), sorted."""
    df = once(docs, __text=F.coalesce(F.col("text").cast("string"), F.lit("")))
    df = _with_stretches(_with_matches(df, __assign=ASSIGN, __access=ACCESS, __hex=HEX, __runs=CANDIDATE).drop("__text"))
    end = lambda m: m["start"] + F.length(m["match"])
    kept = {
        0: F.filter("__assign", lambda m: F.length(F.regexp_extract(m["match"], "^" + ASSIGN, 1)) >= MIN_ASSIGN),
        1: F.filter("__access", lambda m: F.length(m["match"]) >= MIN_ACCESS),
        2: F.col("__hex"),
    }
    mixed = lambda m: m["match"].rlike("[A-Za-z]") & m["match"].rlike("[0-9]") & ~_allowed(m["match"])
    named = lambda kind, found: F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), end(m).alias("end")))
    df = once(df, __base=F.sort_array(F.concat(*[named(kind, found) for kind, found in kept.items()])), __mixed=F.filter("__runs", mixed)).drop("__assign", "__access", "__hex", "__runs")
    limit = lambda m: F.when(m["match"].rlike("^[0-9a-fA-F]+$"), F.lit(HEX_BITS)).otherwise(F.lit(ALPHABET_BITS))
    secret = F.filter("__mixed", lambda m: _window_bits(m["match"]) >= limit(m))
    none = _empty("struct<start:int,kind:int,end:int>")
    df = once(df, __found=F.when(F.size("__mixed") > 0, named(3, secret)).otherwise(none)).drop("__mixed")
    # a base span holds a found one where the largest end of the base spans that begin no later reaches its end
    df = once(df, __all=F.when(F.size("__found") > 0, F.sort_array(F.concat("__base", "__found"))).otherwise(none))
    df = _with_running(df, "__reach", F.array(F.transform("__all", lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(0))), largest=True)
    free = F.zip_with("__all", F.get("__reach", F.lit(0)), lambda s, reach: F.when((s["kind"] < 3) | (reach < s["end"]), s))
    return once(df, __spans=F.when(F.size("__found") > 0, F.array_compact(free)).otherwise(F.col("__base"))).drop("__found", "__all", "__reach")


def _named(array: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one); n_chars follows where there is one."""
    names = docs.columns
    df = _with_running(spans(docs), "__ends", F.array(F.transform("__spans", lambda s: s["end"])), largest=True)
    # (from, to, what follows) of what stays before each span; blocks of them are cut out of the text first, so that no cut reads all of a long text
    stays = F.zip_with("__spans", F.get("__ends", F.lit(0)), lambda s, before: F.struct(
        before.alias("a"), F.greatest(before, s["start"]).alias("b"), F.greatest(before, s["end"]).alias("next"), F.when(s["start"] >= before, F.lit(mark)).otherwise(F.lit("")).alias("mark")))
    df = once(df, __stays=stays)
    some = F.size("__spans") > 0
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("__stays") - 1) / BLOCK).cast("int")), lambda k: F.slice("__stays", k * BLOCK + 1, BLOCK))
    df = once(df, __blocks=F.when(some, F.transform(blocks, lambda xs: F.struct(
        xs.alias("xs"), F.get(xs, F.lit(0))["a"].alias("a"), F.substr(F.col("text"), F.get(xs, F.lit(0))["a"] + 1, F.element_at(xs, -1)["b"] - F.get(xs, F.lit(0))["a"]).alias("text")))))
    cut = F.transform("__blocks", lambda k: F.array_join(F.transform(k["xs"], lambda x: F.concat(F.substr(k["text"], x["a"] - k["a"] + 1, x["b"] - x["a"]), x["mark"])), ""))
    df = once(df, __new=F.when(some, F.concat(F.array_join(cut, ""), F.substr(F.col("text"), F.element_at("__stays", -1)["next"] + 1))).otherwise(F.col("text")))
    new = {"text": F.col("__new"), **({"n_chars": F.when(some, F.length("__new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))} if "n_chars" in names else {})}
    return df.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in names])


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their base counts, the base spans' checksum and all spans."""
    df = spans(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    n = lambda k: F.size(F.filter("__base", lambda s: s["kind"] == k)).cast("long")
    return df.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(_named("__base"), 256).alias("base_sha256"), _named("__spans").alias("spans"))


def _sql_matches(kind: int, pattern: str) -> str:
    """(doc_id, kind, match, start) of a pattern: places from the lengths of what is between and of the matches."""
    quoted = pattern.replace("'", "''")
    size = "list_sum(list_transform({}, lambda x: length(x)))"
    return f"""SELECT doc_id, {kind} AS kind, ms[i] AS match, CAST({size.format("parts[1:i]")} + coalesce({size.format("ms[1:i - 1]")}, 0) AS BIGINT) AS start
  FROM (SELECT doc_id, regexp_extract_all(t, '{quoted}') AS ms, string_split_regex(t, '{quoted}') AS parts FROM d WHERE regexp_matches(t, '{quoted}')) x, unnest(range(1, len(ms) + 1)) AS r(i)"""


def _sql_named(order: str = "start, kind, stop") -> str:
    return f"string_agg(['{"', '".join(KINDS)}'][kind + 1] || ':' || start || ':' || stop, ',' ORDER BY {order})"


_QUOTED = ASSIGN.replace("'", "''")
OP4_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT doc_id, kind, start, start + length(match) AS stop FROM (
  {_sql_matches(0, ASSIGN)}
  UNION ALL {_sql_matches(1, ACCESS)}
  UNION ALL {_sql_matches(2, "[0-9a-f]+")}) m
  WHERE CASE kind WHEN 0 THEN length(regexp_extract(match, '{_QUOTED}', 1)) >= {MIN_ASSIGN} WHEN 1 THEN length(match) >= {MIN_ACCESS} ELSE length(match) >= 24 END),
whole AS (SELECT doc_id, kind, match, start, string_split_regex(match, '{SEPARATOR}') AS parts, regexp_extract_all(match, '{SEPARATOR}') AS seps FROM ({_sql_matches(3, CANDIDATE)}) m),
masked AS (SELECT *, string_split(list_aggregate(list_transform(range(1, len(parts) + 1), lambda i:
    CASE WHEN regexp_matches(lower(parts[i]), '{PLACEHOLDER}') OR (lower(parts[i]) IN {PREFIXES} AND coalesce(seps[i], '') IN ('_', '-')) THEN repeat(' ', length(parts[i])) ELSE parts[i] END
    || coalesce(seps[i], '')), 'string_agg', ''), ' ') AS ps FROM whole),
pieces AS (SELECT doc_id, kind, start, match, ps[i] AS p, i > 1 AS after, i < len(ps) AS before, coalesce(list_sum(list_transform(ps[1:i - 1], lambda x: length(x) + 1)), 0)::BIGINT AS x
  FROM masked, unnest(range(1, len(ps) + 1)) AS u(i)),
trimmed AS (SELECT doc_id, kind, start + x + CASE WHEN after THEN length(p) - length(ltrim(p, '/=_-')) ELSE 0 END AS start,
  CASE WHEN before THEN rtrim(CASE WHEN after THEN ltrim(p, '/=_-') ELSE p END, '/=_-') WHEN after THEN ltrim(p, '/=_-') ELSE p END AS match FROM pieces),
runs AS (SELECT *, start + length(match) AS stop FROM trimmed WHERE length(match) >= {SHORTEST}
  AND regexp_matches(match, '[A-Za-z]') AND regexp_matches(match, '[0-9]') AND NOT regexp_matches(match, '{NUMBERS}') AND NOT regexp_matches(match, '{UUID}')
  AND NOT (regexp_matches(match, '{WORDS}') AND NOT regexp_matches(match, '{TWO_SEPARATORS}'))),
counts AS (SELECT doc_id, start, i, substr(match, i + j, 1) AS c, count(*)::DOUBLE AS n
  FROM runs, unnest(range(1, length(match) - {WINDOW} + 2)) AS w(i), unnest(range(0, {WINDOW})) AS o(j) GROUP BY ALL),
bits AS (SELECT doc_id, start, max(h) AS bits FROM (SELECT doc_id, start, i, -sum(n / {WINDOW} * log2(n / {WINDOW})) AS h FROM counts GROUP BY ALL) x GROUP BY ALL),
added AS (SELECT doc_id, kind, start, stop FROM runs JOIN bits USING (doc_id, start)
  WHERE bits >= CASE WHEN regexp_matches(match, '^[0-9a-fA-F]+$') THEN {HEX_BITS} ELSE {ALPHABET_BITS} END
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = runs.doc_id AND b.start <= runs.start AND b.stop >= runs.stop)),
b AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n0, count(*) FILTER (WHERE kind = 1) AS n1, count(*) FILTER (WHERE kind = 2) AS n2, {_sql_named()} AS names FROM base GROUP BY doc_id),
a AS (SELECT doc_id, {_sql_named()} AS names FROM (SELECT * FROM base UNION ALL SELECT * FROM added) x GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access, CAST(coalesce(n2, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(b.names, '')) AS base_sha256, coalesce(a.names, '') AS spans
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id)"""
