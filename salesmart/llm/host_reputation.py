"""URL filters by empirical-Bayes host reputation, in DataFrame functions only.

Labelled pages vote on their host: a page is bad where its label says so. The
bad rate of a host is shrunk towards that of its registered domain, that
towards its suffix, that towards all pages. Each level's prior is a beta
distribution around the parent's mean; its strength is estimated from the
level's own groups by the method of moments (how much more the rates of the
groups differ than chance would make them). A url is blocked where the lower bound
of its host's posterior, mean less ``Z`` standard deviations, is above
``MAX_BAD``. Fixed rules by host and path come first, the longest that fits.

Hosts are counted with partial sums, so a host with most of the pages is one
small row per task; the join back to the pages is one that Spark can split.

Edges: a null url, or one without ``://``, has an empty host and path; the empty
host is a host like others. Null labels don't vote; repeated rows of pages
or labels vote again. A host without labelled pages gets its domain's mean. An
empty table gives no rows, empty labels the prior mean 1/2 and no strength.
Under the suffixes of several labels in ``SUFFIXES`` (a parameter) each site is a domain; addresses
are domains of their own, and ports tell hosts apart but not domains.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (verdict, host and path)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MAX_BAD = 0.25
Z = 1.645
#: A level's prior counts as so many pages.
STRENGTH = (1.0, 1000.0)
LEVELS = ("suffix", "domain", "host")
#: Suffixes of several labels under which anyone may register; others have one label.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.za", "co.in", "co.jp", "ne.jp", "or.jp", "ac.jp", "co.kr", "com.br", "com.cn", "com.tw",
            "com.hk", "com.sg", "com.mx", "com.ar", "com.tr", "co.il", "github.io", "gitlab.io", "blogspot.com", "wordpress.com", "netlify.app", "vercel.app", "herokuapp.com", "s3.amazonaws.com")
#: Stands for the suffix of all hosts that are addresses.
ADDRESS = "(address)"
_IPV4 = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"
_PORT = ":[0-9]*$"


def with_host(pages: DataFrame) -> DataFrame:
    """Adds host (A-Z lower-cased) and path."""
    url = F.col("url").cast("string")
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise("")
    df = pages.withColumn("__rest", F.coalesce(rest, F.lit("")))
    df = df.withColumn("__host", F.regexp_extract("__rest", "^[^/?#]*", 0))
    path = F.regexp_extract(F.substr(F.col("__rest"), F.length("__host") + F.lit(1)), "^[^?#]*", 0)
    return df.withColumn("path", path).withColumn("host", F.translate("__host", string.ascii_uppercase, string.ascii_lowercase)).drop("__rest", "__host")


def with_levels(df: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Adds suffix (the longest of ``suffixes`` that ends the host's name, else its last label) and domain (one label more).

    A port belongs to the host alone. An address is its own domain, under a suffix of addresses."""
    name = F.regexp_replace("host", _PORT, "")
    suffix, domain = F.substring_index(name, ".", -1), F.substring_index(name, ".", -2)
    for size in sorted({s.count(".") + 1 for s in suffixes}):  # the last, longest one wins
        end = F.substring_index(name, ".", -size)
        fits = end.isin([s for s in suffixes if s.count(".") + 1 == size])
        suffix, domain = F.when(fits, end).otherwise(suffix), F.when(fits, F.substring_index(name, ".", -size - 1)).otherwise(domain)
    address = name.rlike(_IPV4) | name.startswith("[")
    return df.withColumn("domain", F.when(address, name).otherwise(domain)).withColumn("suffix", F.when(address, ADDRESS).otherwise(suffix))


def _level(counts: DataFrame, parent: DataFrame, level: str, up: str | None) -> DataFrame:
    """(level, its parents, mean) with counts shrunk to the parent's mean by the level's strength."""
    of_all = F.col("n") > 0
    each = counts.withColumn("rate", F.try_divide("bad", "n"))
    total = counts.agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("b"), F.coalesce(F.sum("n"), F.lit(0)).alias("t"), F.coalesce(F.sum(F.col("n") * F.col("n")), F.lit(0)).alias("t2"), F.count(F.when(of_all, 1)).alias("k"))
    total = total.withColumn("p", F.coalesce(F.try_divide("b", "t"), F.lit(0.5)))
    spread = each.crossJoin(F.broadcast(total)).agg(F.sum(F.col("n") * (F.col("rate") - F.col("p")) * (F.col("rate") - F.col("p"))).alias("s"))  # one row on the right
    moments = total.crossJoin(F.broadcast(spread))
    chance = F.col("p") * (1 - F.col("p"))
    excess = F.try_divide(F.col("s"), chance) - (F.col("k") - 1)  # null where nothing can be estimated
    room = F.col("t") - F.try_divide("t2", "t") - (F.col("k") - 1)
    strength = F.when((room > 0) & (excess > 0), F.try_divide(room, excess) - 1).otherwise(STRENGTH[1])
    strength = F.least(F.greatest(strength, F.lit(STRENGTH[0])), F.lit(STRENGTH[1]))
    prior = counts.crossJoin(F.broadcast(moments.select(strength.alias("strength"))))  # one row
    prior = prior.crossJoin(F.broadcast(parent)) if up is None else prior.join(parent.select(up, F.col("mean").alias("prior")), up)
    return prior.withColumn("mean", (F.col("bad") + F.col("strength") * F.col("prior")) / (F.col("n") + F.col("strength")))


def reputation(pages: DataFrame, labels: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """(host, bad_bound) for every host of ``pages`` (page_id, host); ``labels`` (doc_id, quality, toxic) vote for the page of their id."""
    votes = labels.select(F.col("doc_id").alias("page_id"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0).alias("bad"))
    voted = pages.select("page_id", "host").join(votes.where("bad IS NOT NULL").groupBy("page_id").agg(F.count("*").alias("n"), F.sum("bad").alias("bad")), "page_id", "left")
    hosts = with_levels(voted.groupBy("host").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad")), suffixes)
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    ends = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    everything = ends.agg(F.coalesce(F.try_divide(F.sum("bad"), F.sum("n")), F.lit(0.5)).alias("prior"))
    of_suffix = _level(ends, everything, "suffix", None)
    of_domain = _level(domains, of_suffix, "domain", "suffix")
    of_host = _level(hosts, of_domain, "host", "domain")
    a, b = F.col("bad") + F.col("strength") * F.col("prior"), F.col("n") - F.col("bad") + F.col("strength") * (1 - F.col("prior"))
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return of_host.select("host", (F.col("mean") - Z * deviation).alias("bad_bound"))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits as struct (size, rule, verdict), else null."""
    fits = []
    for verdict, rule in rules:
        of_host, slash, of_path = rule.partition("/")
        fit = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(slash + of_path)
        fits.append(F.when(fit, F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*fits))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES, max_bad: float = MAX_BAD, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages`` (page_id, url)."""
    df = with_host(pages.select("page_id", "url")).drop("url")
    by_host = reputation(df, labels, suffixes)
    df = df.join(by_host, "host").withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("bad_bound") > max_bad, "block").otherwise("allow"))
    return df.select("page_id", "host", "path", F.col("__rule.rule").alias("rule"), verdict.alias("verdict"))


def op9_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages with the verdict on their url."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _sql_level(level: str, counts: str, prior: str, keys: str) -> str:
    return f"""
{level}_t AS (SELECT coalesce(sum(bad), 0)::DOUBLE AS b, coalesce(sum(n), 0)::DOUBLE AS t, coalesce(sum(n * n), 0)::DOUBLE AS t2, (count(*) FILTER (WHERE n > 0))::DOUBLE AS k FROM {counts}),
{level}_p AS (SELECT *, CASE WHEN t > 0 THEN b / t ELSE 0.5::DOUBLE END AS p FROM {level}_t),
{level}_v AS (SELECT p.*, (SELECT sum(n * (bad::DOUBLE / n - p.p) * (bad::DOUBLE / n - p.p)) FROM {counts} WHERE n > 0) AS s FROM {level}_p p),
{level}_k AS (SELECT least(greatest(CASE WHEN t > 0 AND p > 0 AND p < 1 AND t - t2 / t - (k - 1) > 0 AND s / (p * (1 - p)) - (k - 1) > 0
              THEN (t - t2 / t - (k - 1)) / (s / (p * (1 - p)) - (k - 1)) - 1 ELSE {STRENGTH[1]}::DOUBLE END, {STRENGTH[0]}::DOUBLE), {STRENGTH[1]}::DOUBLE) AS strength FROM {level}_v),
{level}_m AS (SELECT {keys}, n, bad, strength, prior, (bad + strength * prior) / (n + strength) AS mean FROM {counts} c, {level}_k, {prior})"""


OP9_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, coalesce(rest, '') AS rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw FROM u),
pg AS (SELECT page_id, translate(raw, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
votes AS (SELECT doc_id, count(*) AS n, sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
voted AS (SELECT host, regexp_replace(host, '{_PORT}', '') AS name, coalesce(sum(n), 0) AS n, coalesce(sum(bad), 0) AS bad FROM pg LEFT JOIN votes ON page_id = doc_id GROUP BY host),
ends AS (SELECT s, length(s) - length(replace(s, '.', '')) + 1 AS size FROM (VALUES {", ".join(f"('{x}')" for x in SUFFIXES)}) AS t(s)),
sized AS (SELECT host, greatest(coalesce(max(size), 1), 1) AS size FROM voted LEFT JOIN ends ON name = s OR ends_with(name, '.' || s) GROUP BY host),
hosts AS (SELECT host, n, bad, CASE WHEN regexp_matches(name, '{_IPV4}') OR starts_with(name, '[') THEN '{ADDRESS}' ELSE array_to_string(list_slice(string_split(name, '.'), -size, -1), '.') END AS suffix,
                 CASE WHEN regexp_matches(name, '{_IPV4}') OR starts_with(name, '[') THEN name ELSE array_to_string(list_slice(string_split(name, '.'), -size - 1, -1), '.') END AS domain
          FROM voted JOIN sized USING (host)),
domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix, domain),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
everything AS (SELECT CASE WHEN sum(n) > 0 THEN sum(bad)::DOUBLE / sum(n) ELSE 0.5::DOUBLE END AS prior FROM suffixes),
{_sql_level("s", "suffixes", "everything", "suffix").strip()},
{_sql_level("d", "domains", "(SELECT suffix AS up, mean AS prior FROM s_m) up WHERE up.up = c.suffix", "domain").strip()},
{_sql_level("o", "hosts", "(SELECT domain AS up, mean AS prior FROM d_m) up WHERE up.up = c.domain", "host").strip()},
bound AS (SELECT host, mean - {Z}::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bad_bound
          FROM (SELECT host, mean, bad + strength * prior AS a, n - bad + strength * (1 - prior) AS b FROM o_m) x),
rules(verdict, rule, rhost, rpath) AS (VALUES {", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '{'/' + r.partition('/')[2]}')" for v, r in RULES)}),
best AS (SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
         FROM (SELECT DISTINCT page_id, host, path FROM pg) p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY ALL)
SELECT pg.page_id, pg.host, pg.path, best.rule, coalesce(best.verdict, CASE WHEN bad_bound > {MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict
FROM pg JOIN bound USING (host) LEFT JOIN best ON best.page_id = pg.page_id AND best.host = pg.host AND best.path = pg.path"""
