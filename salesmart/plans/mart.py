"""E18 refresh: build the star schema from the sources, write it, read it back.

``build_mart`` is lazy (a plan, nothing runs). ``write_mart`` persists it
as Parquet (S5): dimensions one folder each, facts partitioned by order
year ``annee`` so that year filters prune files.

A refresh writes a version: the dimensions under ``<root>/<version>``, the
facts under ``<root>/<fact>/load=<version>/annee=<year>``, then its marker in
``_versions``. The marker lists, per fact and year, the load that holds it.
An incremental refresh writes only the years whose source rows changed and
takes the others from earlier loads as they are. Which years changed is told by
their prints: sums of hashes over the orders and lines of a year, stored with
the version. Years that hold rows of members new in a dimension change too.
Beside the prints lie the totals of Q1 and Q2 by year, of the source from the
scan for the prints and of the mart from the writing stages, so ``load_checks``
answers for the whole version without reading a table.

Markers are never changed and readers take the newest, so a crash at any
moment leaves the previous version current. Re-running a refresh gives the same
tables, keys included, unlike the source load whose sales insert
doubled the fact on a second run.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Iterable
from dataclasses import replace
from decimal import Decimal
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from salesmart.functions import to_money
from salesmart.functions.clustering import between, day_part, first_byte, interleaved
from salesmart.functions.keys import natural_key
from salesmart.operators import dims, facts
from salesmart.operators.merge import insert_if_absent
from salesmart.operators.quality import NOT_NULL
from salesmart.plans.model import Attributes, BuiltMart, Mart, Oltp
from salesmart.schema import SENTINEL

FACTS = ("fait_livraisons", "fait_ventes")
DIM_KEYS = {
    "dim_temps": ["date_key"],
    "dim_client": ["codecli"],
    "dim_employe": ["noemp"],
    "dim_transporteur": ["notran"],
    "dim_geo": list(dims.GEO_COLS),
    "dim_produit": ["refprod"],
}


HASHED = {"dim_client": "client_key", "dim_geo": "geo_key"}
# Distinct on their key by construction.
DISTINCT = ("dim_temps", "dim_geo")


def build_dims(oltp: Oltp, sentinels: Iterable[str] = (SENTINEL,), existing: Mart | None = None) -> dict[str, DataFrame]:
    """The six dimensions (E2, E4–E8), insert-if-absent into ``existing``;
    the first load goes the same way, so repeated members collapse there too."""
    s = tuple(sentinels)
    new = {
        "dim_temps": dims.dim_date(oltp.commande),
        "dim_client": dims.client_rows(oltp.client, s),
        "dim_employe": dims.dim_employe(oltp.employe, s),
        "dim_transporteur": dims.dim_transporteur(oltp.transporteur),
        "dim_geo": dims.geo_rows(oltp.commande, s),
        "dim_produit": dims.dim_produit(oltp.produit, oltp.categorie, oltp.fournisseur, s),
    }
    for name, df in new.items():
        members = getattr(existing, name).drop(HASHED.get(name, "")) if existing is not None else None
        if members is not None or name not in DISTINCT:
            df = insert_if_absent(members, df, DIM_KEYS[name])
        if name in HASHED:
            df = df.select(natural_key(*DIM_KEYS[name]).alias(HASHED[name]), *df.columns)
        new[name] = df
    return new


def build_mart(oltp: Oltp, sentinels: Iterable[str] = (SENTINEL,), existing: Mart | None = None) -> BuiltMart:
    """Lazy star schema: dimensions, then deliveries, then sales (the
    source load order), as one plan per table.

    With ``existing``, dimensions are loaded insert-if-absent (E10):
    members already in the mart keep their row, new ones are added. Facts
    are built from the sources; ``refresh`` does that for some years only.
    """
    s = tuple(sentinels)
    new = build_dims(oltp, s, existing)

    def deliveries(client: Attributes, employe: Attributes) -> DataFrame:
        return facts.fact_deliveries(oltp.commande, oltp.detailcommande, new["dim_client"], new["dim_employe"],
                                     new["dim_transporteur"], s, client, employe)

    def sales(produit: Attributes, client: Attributes, employe: Attributes) -> DataFrame:
        return facts.fact_sales(oltp.detailcommande, deliveries(client, employe), new["dim_produit"], produit, [*client, *employe])

    liv = deliveries({}, {})
    ventes = facts.fact_sales(oltp.detailcommande, liv, new["dim_produit"])
    return BuiltMart(fait_livraisons=liv, fait_ventes=ventes, **new, attributed=sales, built=(liv, ventes))


def _table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


#: Order date of each fact; the facts lie on a curve through it and the keys of these.
FACT_DATE = {"fait_livraisons": "datecom_key", "fait_ventes": "date_key"}
#: Row groups can be skipped for one order by these filters, as by an index.
BLOOM = {"parquet.bloom.filter.enabled#nocom": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def product_bounds(dim_produit: DataFrame) -> tuple[int, int]:
    """The least and greatest product key (0, 0 without products)."""
    row = dim_produit.agg(F.min("refprod"), F.max("refprod")).first()
    return (row[0], row[1]) if row[0] is not None else (0, 0)


def write_table(name: str, df: DataFrame, root: str, mode: str = "overwrite", products: tuple[int, int] = (0, 0)) -> None:
    """S5 for one table. Facts are dealt to tasks by ranges of year, then of
    a curve through date, client and product (``products``: the bounds of the
    product keys), then of order, product and line, and are written by
    ``annee`` in that order. So each file and row group has narrow bounds on
    date, client and product, one order's lines go to as many tasks as
    they need, and the files number about as many as the shuffle partitions.
    A bloom filter on ``nocom`` lets a scan for one order skip row groups."""
    _write_table(name, df, _table_path(root, name), mode, products)


def _observed(name: str, df: DataFrame, years: Iterable[int | None] = ()) -> tuple[DataFrame, Observation]:
    """The rows on their way to the writer, and their figures for Q1, Q2 and Q6; those of Q1 and Q2 also by year, named ``(year)``.

    The writer's stage ends its job, and Spark counts a task of such a stage once however often it is tried."""
    observation = Observation()
    figures = [F.count(F.lit(1)).alias("n_rows"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in NOT_NULL.get(name, [])]]
    if name == "fait_ventes":
        figures.append(F.sum("montant_net").alias("ca_dw"))
    for year in years:
        here = F.col("annee").eqNullSafe(F.lit(year).cast("int"))
        figures.append((F.sum(F.when(here, F.col("montant_net"))) if name == "fait_ventes" else F.count(F.when(here, 1))).alias(f"({year})"))
    return df.observe(observation, *figures), observation


def _write_table(name: str, df: DataFrame, path: str, mode: str, products: tuple[int, int], years: Iterable[int | None] = ()) -> dict:
    if name not in FACTS:
        seen, figures = _observed(name, df)
        seen.write.mode(mode).parquet(path)
        return figures.get
    axes, by = [day_part(FACT_DATE[name]), first_byte("client_key")], ["annee", "_place", "nocom"]
    if name == "fait_ventes":
        axes.append(between("produit_key", *products))
        by += ["produit_key", "copie" if "copie" in df.columns else "ventes_key"]
    placed = df.withColumn("_place", interleaved(*axes)).repartitionByRange(*by).sortWithinPartitions(*by).drop("_place")
    if "copie" in df.columns:  # the exchange carries a small number, not the key
        placed = facts.with_line_keys(placed)
    seen, figures = _observed(name, placed, years)
    seen.write.mode(mode).options(**BLOOM).partitionBy("annee").parquet(path)
    return figures.get


def write_mart(mart: Mart, root: str, mode: str = "overwrite") -> None:
    """Parquet per table, each table from its own lazy plan."""
    products = product_bounds(mart.dim_produit)
    for name, df in mart.tables().items():
        write_table(name, df, root, mode, products)


def _load_dims(oltp: Oltp, root: str, sentinels: tuple[str, ...], existing: Mart | None) -> tuple[dict[str, DataFrame], dict[str, dict]]:
    """The dimensions, written under ``root`` and read back, and their figures."""
    spark = oltp.commande.sparkSession
    # the six dimension loads are independent jobs: submit them together so
    # small ones do not leave the cluster idle while they run one by one
    plan = build_dims(oltp, sentinels, existing)
    write = inheritable_thread_target(spark)(_write_table)  # job group and pool of the caller
    with ThreadPoolExecutor(max_workers=len(plan)) as pool:
        running = {name: pool.submit(write, name, df, _table_path(root, name), "overwrite", (0, 0)) for name, df in plan.items()}
        figures = {name: f.result() for name, f in running.items()}
    return {name: spark.read.schema(plan[name].schema).parquet(_table_path(root, name)) for name in DIM_KEYS}, figures


def _load_facts(oltp: Oltp, d: dict[str, DataFrame], paths: dict[str, str], sentinels: tuple[str, ...],
                years: Iterable[int | None] = ()) -> tuple[dict[str, str], dict[str, dict]]:
    """The facts, written to their ``paths``; their schemas, as JSON, and their figures, of ``years`` also by year."""
    products = product_bounds(d["dim_produit"])
    liv = facts.fact_deliveries(oltp.commande, oltp.detailcommande, d["dim_client"], d["dim_employe"], d["dim_transporteur"], sentinels)
    figures = {"fait_livraisons": _write_table("fait_livraisons", liv, paths["fait_livraisons"], "overwrite", products, years)}
    header = _read_years(oltp.commande.sparkSession, liv.schema.json(), paths["fait_livraisons"], None)
    lines = facts.sales_lines(oltp.detailcommande, header, d["dim_produit"])
    figures["fait_ventes"] = _write_table("fait_ventes", lines, paths["fait_ventes"], "overwrite", products, years)
    return {"fait_livraisons": liv.schema.json(), "fait_ventes": facts.with_line_keys(lines).schema.json()}, figures


def _read_years(spark: SparkSession, schema: str, base: str, folders: list[str] | None) -> DataFrame:
    """A fact from some folders under ``base`` (None: all); no files are needed to know its columns."""
    declared = T.StructType.fromJson(json.loads(schema))
    if folders == []:
        return spark.createDataFrame([], declared)
    read = spark.read.schema(declared).option("basePath", base)
    return read.parquet(*(folders if folders is not None else [base])).select(*declared.names)


def load_mart(oltp: Oltp, root: str, sentinels: Iterable[str] = (SENTINEL,),
              existing: Mart | None = None) -> Mart:
    """Staged load into ``root``: dimensions are written and read back,
    then the delivery fact, read back as the order header of the sales
    fact. Each stage reads the previous one's files, so lineage stays
    short (a lost executor only recomputes the current stage) and join
    strategies are chosen on exact file sizes. The plans are those of
    ``build_mart``.
    """
    s = tuple(sentinels)
    d, _ = _load_dims(oltp, root, s, existing)
    paths = {name: _table_path(root, name) for name in FACTS}
    schemas, _ = _load_facts(oltp, d, paths, s)
    return Mart(**d, **{name: _read_years(oltp.commande.sparkSession, schemas[name], path, None) for name, path in paths.items()})


def read_mart(spark: SparkSession, root: str) -> Mart:
    """Read a written mart; partition discovery restores ``annee``."""
    return Mart(**{name: spark.read.parquet(_table_path(root, name)) for name in Mart.__dataclass_fields__})


# ------------------------------------------------------------------- years
PRINTS = "annee int, n_orders long, order_print decimal(38,0), n_lines long, line_print decimal(38,0), ca_oltp decimal(38,4)"
#: What a version stores of each year: its print, and the totals of its facts.
YEARS = f"{PRINTS}, commandes_dw long, ca_dw decimal(38,4)"


def year_prints(oltp: Oltp) -> DataFrame:
    """A print per order year of the source rows that its facts are made of.

    Rows are hashed and the hashes summed, so the print does not depend on
    their order and repeated rows count. Lines are summed per order before they
    meet their order's year (partial sums: a hot order is a row per task).
    Orders without a date, and lines without an order, are of year NULL.
    The same scan gives the net revenue of the lines, unrounded as in Q1; where two orders
    share a number (Q3 reports them), their lines count for each.
    """
    def row_print(columns: Iterable[str]) -> F.Column:
        # the hash passes NULLs over, so it is told where they are; 28 digits leave room for 10^19 rows
        return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns]).cast("decimal(28,0)")

    net = F.sum(F.col("qte") * F.col("prixunit") * (F.lit(1) - F.col("remise")))
    lines = oltp.detailcommande.groupBy("nocom").agg(F.count(F.lit(1)).alias("_n"), F.sum(row_print(facts.LINE)).alias("_print"), net.cast("decimal(38,4)").alias("_net"))
    orders = oltp.commande.select("nocom", F.year("datecom").alias("annee"), row_print(oltp.commande.columns).alias("_order"))
    both = orders.join(lines, "nocom", "full")
    none = F.lit(0).cast("decimal(38,0)")
    return both.groupBy("annee").agg(
        F.count("_order").alias("n_orders"), F.coalesce(F.sum("_order"), none).cast("decimal(38,0)").alias("order_print"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_lines"), F.coalesce(F.sum(F.col("_print").cast("decimal(28,0)")), none).cast("decimal(38,0)").alias("line_print"),
        F.sum("_net").cast("decimal(38,4)").alias("ca_oltp"))


def _years(df: DataFrame) -> set[int | None]:
    return {r["annee"] for r in df.select("annee").distinct().collect()}  # as many as the calendar has years


def _year_rows(oltp: Oltp) -> list[tuple]:
    return [tuple(r) for r in year_prints(oltp).collect()]  # a row per year


def _in_years(years: set[int | None]) -> F.Column:
    year = F.year("datecom")
    return F.when(year.isNull(), F.lit(None in years)).otherwise(year.isin([y for y in years if y is not None]))


def _of_years(oltp: Oltp, years: set[int | None]) -> Oltp:
    orders = oltp.commande.where(_in_years(years))
    return replace(oltp, commande=orders, detailcommande=oltp.detailcommande.join(orders.select("nocom"), "nocom", "left_semi"))


def _years_of_new_members(oltp: Oltp, d: dict[str, DataFrame], existing: Mart) -> set[int | None]:
    """Years of the orders that name a customer, employee, carrier or product the mart did not have.

    Such orders and lines were dropped or without a key so far."""
    def new(name: str) -> DataFrame:
        key = DIM_KEYS[name]
        return d[name].select(*key).join(getattr(existing, name).select(*key), key, "left_anti")

    fresh = {name: new(name) for name in ("dim_client", "dim_employe", "dim_transporteur", "dim_produit")}
    orders = oltp.commande.withColumn("annee", F.year("datecom"))
    found = [orders.join(fresh[name], DIM_KEYS[name], "left_semi") for name in ("dim_client", "dim_employe", "dim_transporteur")]
    found.append(orders.join(oltp.detailcommande.join(fresh["dim_produit"], "refprod", "left_semi").select("nocom").distinct(), "nocom", "left_semi"))
    return _years(reduce(DataFrame.unionByName, [f.select("annee") for f in found]))


# ---------------------------------------------------------------- versions
FIGURES = "table_name string, figure string, value decimal(38,4)"
MARKER = "seq long, version string, facts array<struct<name string, annee int, load string>>, schemas map<string, string>"


def _markers(root: str) -> str:
    return f"{root.rstrip('/')}/_versions"


def _load_path(root: str, name: str, load: str, annee: int | None | str = "") -> str:
    """The folder of a load of a fact, or of one year of it."""
    folder = f"{_table_path(root, name)}/load={load}"
    return folder if annee == "" else f"{folder}/annee={'__HIVE_DEFAULT_PARTITION__' if annee is None else annee}"


def _read_version(spark: SparkSession, root: str, marker: Row) -> Mart:
    declared = {name: T.StructType.fromJson(json.loads(marker["schemas"][name])) for name in DIM_KEYS}
    tables = {name: spark.read.schema(schema).parquet(_table_path(f"{root.rstrip('/')}/{marker['version']}", name)) for name, schema in declared.items()}
    for name in FACTS:
        folders = [_load_path(root, name, f["load"], f["annee"]) for f in marker["facts"] if f["name"] == name]
        tables[name] = _read_years(spark, marker["schemas"][name], _table_path(root, name), folders)
    return Mart(**tables)


def refresh(spark: SparkSession, oltp: Oltp, root: str, sentinels: Iterable[str] = (SENTINEL,),
            incremental: bool = False, changed: DataFrame | None = None) -> Mart:
    """Load a new mart version under ``root`` and make it current.

    ``root`` must be on storage shared by the cluster (the same place as
    ``spark.checkpoint.dir``). The marker is appended through Spark, whose
    commit makes its file visible at once or not at all.

    ``incremental`` keeps the members of the dimensions and rewrites the facts of
    changed years only. All sources are read for their prints, unless
    ``changed`` names the orders (nocom) that are new or whose header
    or lines changed: then only their years are looked at, and the caller
    answers for the rest.
    """
    base, s = root.rstrip("/"), tuple(sentinels)
    before = _newest(spark, root)
    version = f"v-{uuid.uuid4().hex[:12]}"
    existing = _read_version(spark, root, before) if incremental and before else None
    d, figures = _load_dims(oltp, f"{base}/{version}", s, existing)
    if existing is None:
        prints, touched, part, kept = _year_rows(oltp), None, oltp, {}
        written = [p[0] for p in prints]
    else:
        stored = [tuple(r) for r in spark.read.schema(YEARS).parquet(f"{base}/{before['version']}/_years").collect()]  # a row per year
        old = [r[:-2] for r in stored]
        if changed is None:
            prints = _year_rows(oltp)
            touched = {p[0] for p in set(old) ^ set(prints)}
        else:
            touched = _years(oltp.commande.join(changed.select("nocom").distinct(), "nocom", "left_semi").select(F.year("datecom").alias("annee")))
            prints = [p for p in old if p[0] not in touched] + _year_rows(_of_years(oltp, touched))
        touched |= _years_of_new_members(oltp, d, existing)
        part, kept = _of_years(oltp, touched), {r[0]: r[-2:] for r in stored if r[0] not in touched}
        written = sorted(touched, key=str)
    if touched == set():
        listed, schemas = list(before["facts"]), before["schemas"]
    else:
        paths = {name: _load_path(root, name, version) for name in FACTS}
        schemas, of_facts = _load_facts(part, d, paths, s, written)
        by_year = {name: {year: of_facts[name].pop(f"({year})") for year in written} for name in FACTS}
        kept |= {year: (by_year["fait_livraisons"][year], by_year["fait_ventes"][year]) for year in written}
        figures |= of_facts
        listed = [] if touched is None else [f for f in before["facts"] if f["annee"] not in touched]
        for name, path in paths.items():
            listed += [(name, annee, version) for annee in sorted(_years(_read_years(spark, schemas[name], path, None)), key=str)]
    spark.createDataFrame([(*p, *kept.get(p[0], (0, None))) for p in prints], YEARS).coalesce(1).write.parquet(f"{base}/{version}/_years")
    seen = [(table, figure, Decimal(value or 0)) for table, row in figures.items() for figure, value in row.items()]
    spark.createDataFrame(seen, FIGURES).coalesce(1).write.parquet(f"{base}/{version}/_figures")
    schemas = {**schemas, **{name: df.schema.json() for name, df in d.items()}}
    marker = ((before["seq"] if before else 0) + 1, version, [tuple(f) for f in listed], schemas)
    spark.createDataFrame([marker], MARKER).coalesce(1).write.mode("append").json(_markers(root))
    return _read_version(spark, root, Row(version=version, facts=[Row(name=n, annee=a, load=v) for n, a, v in marker[2]], schemas=schemas))


def _read_markers(spark: SparkSession, root: str) -> DataFrame | None:
    """The markers, newest first; None where no mart was loaded."""
    try:
        markers = spark.read.schema(MARKER).json(_markers(root))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # only a mart never loaded has no markers
            raise
        return None
    return markers.orderBy(F.col("seq").desc(), F.col("version").desc())


def _newest(spark: SparkSession, root: str) -> Row | None:
    markers = _read_markers(spark, root)
    return markers.first() if markers is not None else None


def current_version(spark: SparkSession, root: str) -> str | None:
    newest = _newest(spark, root)
    return newest["version"] if newest else None


def expire_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete what only versions before the newest ``keep`` use: their dimensions, and the years of
    the facts that no kept version lists. Markers stay. Returns the versions deleted."""
    if keep < 1:
        raise ValueError("the current version stays")
    markers = _read_markers(spark, root)
    rows = markers.collect() if markers is not None else []  # a row per refresh
    kept = {tuple(f) for r in rows[:keep] for f in r["facts"]}
    jvm, base = spark.sparkContext._jvm, root.rstrip("/")

    def delete(folder: str) -> bool:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    loads = {(name, load) for name, _, load in kept}
    gone = []
    for r in rows[keep:]:
        for name, annee, load in map(tuple, r["facts"]):
            if (name, load) not in loads:
                delete(_load_path(root, name, load))
            elif (name, annee, load) not in kept:
                delete(_load_path(root, name, load, annee))
        if delete(f"{base}/{r['version']}"):
            gone.append(r["version"])
    return gone


def load_figures(spark: SparkSession, root: str) -> DataFrame | None:
    """(table_name, figure, value) of the rows that the newest load wrote, as counted while it wrote them:
    ``n_rows``, the NULLs of each NOT NULL column (Q6), and ``ca_dw``, the net revenue (Q1).

    After an incremental refresh they are of the dimensions and of the years it wrote; a fact of which it wrote
    no year has none. None where no mart was loaded.
    """
    newest = _newest(spark, root)
    return spark.read.schema(FIGURES).parquet(f"{root.rstrip('/')}/{newest['version']}/_figures") if newest else None


def load_checks(spark: SparkSession, root: str) -> dict[str, DataFrame] | None:
    """Q1 and Q2 of the current version, as the registered checks give them, from what its loads counted.

    Neither a source nor a fact is read: a year's totals were taken by the load that wrote it, on the
    source's side by the scan for its prints. With ``changed`` orders named by the caller, the source's side of
    the other years is that of the load before. None where no mart was loaded.
    """
    newest = _newest(spark, root)
    if newest is None:
        return None
    total = spark.read.schema(YEARS).parquet(f"{root.rstrip('/')}/{newest['version']}/_years").agg(
        F.sum("ca_oltp").alias("ca_oltp"), F.sum("ca_dw").alias("ca_dw"),
        F.coalesce(F.sum("n_orders"), F.lit(0)).alias("commandes_oltp"), F.coalesce(F.sum("commandes_dw"), F.lit(0)).alias("commandes_dw"))
    return {
        "dq_revenue_reconciliation": total.select(to_money(F.col("ca_oltp")).alias("ca_oltp"), to_money(F.col("ca_dw")).alias("ca_dw"),
                                                  to_money(F.col("ca_dw") - F.col("ca_oltp")).alias("ecart")),
        "dq_order_count": total.select("commandes_oltp", "commandes_dw", (F.col("commandes_oltp") - F.col("commandes_dw")).alias("ecart")),
    }


def current_mart(spark: SparkSession, root: str) -> Mart | None:
    newest = _newest(spark, root)
    return _read_version(spark, root, newest) if newest else None


def table_counts(mart: Mart) -> DataFrame:
    """Row count per mart table (one aggregate per table, unioned)."""
    parts = [df.select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
             for name, df in mart.tables().items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
