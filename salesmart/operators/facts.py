"""Fact loads E12–E17.

Plan at scale (one order may carry a third of all lines):

* order totals (E14) are a partial aggregate of the lines, stored on the
  order-grain fact — not a window, which would put every line of a hot
  order into one task;
* the sales fact is then one two-input join, lines ⋈ order fact on
  ``nocom``; with the order fact read back from its files (staged load)
  both inputs are plain shuffles, and AQE's skew-join splits a hot
  order's partition on the line side, replicating the one-row order side;
* dimension keys are computed, not looked up (``salesmart.functions.keys``);
  the inner joins of the source load that drop rows without a customer,
  employee or product are LEFT SEMI joins that Spark broadcasts or
  shuffles by the dimension's size, which AQE can split;
* ``ventes_key`` is the key of a line's content and its number among lines
  equal in all columns (``numbered_lines``): lines have no natural key, but
  equal ones are interchangeable, so every load and retry gives the same keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import date_key
from salesmart.functions.keys import natural_key
from salesmart.operators.dims import GEO_COLS, clean_geo
from salesmart.schema import AMOUNT, DETAILCOMMANDE, RATE, SENTINEL

NET_EXACT = "decimal(18,4)"    # qte * prixunit * (1 - remise) is exact at scale 4


def line_amounts(detail: DataFrame, more: Iterable[str] = ()) -> DataFrame:
    """Gross and net amount of each line, unrounded (``more``: columns to keep)."""
    brut = F.col("qte") * F.col("prixunit")
    return detail.select(
        "nocom", "refprod", "qte", "prixunit", "remise", *more,
        brut.alias("montant_brut"),
        (brut * (F.lit(1) - F.col("remise"))).cast(NET_EXACT).alias("montant_net"),
    )


LINE = ("nocom", "refprod", "prixunit", "qte", "remise")
#: Equal lines that one task writes out in a row.
COPIES = 4096


def numbered_lines(detail: DataFrame) -> DataFrame:
    """The lines with ``copie``, their number among lines equal in all columns.

    Counted with partial sums, so a line repeated on a third of the table is
    a row per task before the exchange; then a row is written out for each
    copy. Lines with more than ``COPIES`` copies are first cut into ranges that
    go to different tasks, so no window and no task sees all copies of a line.
    """
    counted = detail.groupBy(*LINE).agg(F.count(F.lit(1)).alias("_n"))
    few = counted.where(F.col("_n") <= COPIES).select(*LINE, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("copie"))
    ranges = (counted.where(F.col("_n") > COPIES)
              .select(*LINE, "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPIES).cast("long"))).alias("_first"))
              .repartition(*LINE, "_first"))
    last = F.least(F.col("_first") + COPIES, F.col("_n")) - 1
    return few.unionByName(ranges.select(*LINE, F.explode(F.sequence("_first", last)).alias("copie")))


def order_net_total(lines: DataFrame) -> DataFrame:
    """SUM(net) per order, DECIMAL(28,4) (partial aggregation before the shuffle)."""
    return lines.groupBy("nocom").agg(F.sum("montant_net").alias("total_net"))


def allocated_freight(port: str = "port", net: str = "montant_net", total: str = "total_net") -> F.Column:
    """Order freight shared over its lines in proportion to net amount.

    0 when the order total is not positive; rounded HALF_UP to cents per
    line, so the allocations of an order may differ from its freight by a
    few cents (reported by Q8).
    """
    share = F.col(port) * (F.col(net) / F.col(total))
    return F.when(F.col(total) > 0, share).otherwise(F.lit(0)).cast(AMOUNT)


def _known(rows: DataFrame, dim: DataFrame, key: str, attributes: Mapping[str, str]) -> DataFrame:
    """The rows whose member is in ``dim``, with attributes of it by their new name (the key keeps its own).
    A dimension has each member once, so a join for attributes keeps the rows that LEFT SEMI keeps."""
    wanted = [F.col(c).alias(n) for n, c in attributes.items() if c != key]
    return rows.join(dim.select(key, *wanted), key, "inner" if wanted else "left_semi")


def fact_deliveries(commande: DataFrame, detail: DataFrame, dim_client: DataFrame, dim_employe: DataFrame,
                    dim_transporteur: DataFrame, sentinels: Iterable[str] = (SENTINEL,),
                    client: Mapping[str, str] = {}, employe: Mapping[str, str] = {}) -> DataFrame:
    """One row per order with a known customer and employee.

    Besides the source columns it keeps ``total_net``, the order's net
    total over all its lines (E14, NULL for an order without lines): the
    denominator of the freight allocation. Storing it here makes the sales
    fact a two-input join of lines with this table, which AQE can split
    when one order holds a large share of the lines.

    ``client`` and ``employe`` name attributes of the two to append (name →
    column of the dimension).
    """
    orders = _known(_known(commande, dim_client, "codecli", client), dim_employe, "noemp", employe)
    orders = (orders.join(dim_transporteur.select("notran", "transporteur_key"), "notran", "left")
              .join(order_net_total(line_amounts(detail)), "nocom", "left"))
    cleaned = orders.select(
        "nocom", "codecli", "noemp", "transporteur_key", "datecom", "dateenv", "dateobjliv", "port", "total_net",
        *clean_geo(sentinels), *[c for c in [*client, *employe] if c not in ("codecli", "noemp")])
    return _fact_deliveries(cleaned.withColumns({"client_key": natural_key("codecli"), "geo_key": natural_key(*GEO_COLS)}), [*client, *employe])


def _fact_deliveries(cleaned: DataFrame, more: Iterable[str]) -> DataFrame:
    dateenv, dateobj, datecom = F.col("dateenv"), F.col("dateobjliv"), F.col("datecom")
    return cleaned.select(
        F.col("nocom").alias("liv_key"),
        date_key(datecom).alias("datecom_key"),
        date_key(dateenv).alias("dateenv_key"),
        date_key(dateobj).alias("dateobj_key"),
        "client_key",
        F.col("noemp").cast("bigint").alias("employe_key"),
        "transporteur_key",
        "geo_key",
        "nocom", "port",
        F.datediff(dateenv, datecom).alias("delai_envoi_jours"),
        F.when(dateenv.isNotNull() & dateobj.isNotNull(),
               F.greatest(F.lit(0), F.datediff(dateenv, dateobj))).alias("retard_jours"),
        "total_net",
        F.year(datecom).alias("annee"),
        *more,
    )


def fact_sales(detail: DataFrame, deliveries: DataFrame, dim_produit: DataFrame,
               produit: Mapping[str, str] = {}, more: Iterable[str] = ()) -> DataFrame:
    """One row per order line whose order and product are known.

    ``deliveries`` is the order-grain fact (E12): it already carries the
    order's keys and net total, and applies the customer / employee
    row-loss rules the source load applies to the lines. Read back from
    its files (staged load), the join below has two shuffled inputs, the
    shape AQE's skew-join handles.

    ``produit`` names attributes of the product to append (name → column of
    the dimension), ``more`` further columns of ``deliveries``.
    """
    return with_line_keys(sales_lines(detail, deliveries, dim_produit, produit, more))


def with_line_keys(lines: DataFrame) -> DataFrame:
    """``ventes_key`` in front, from a line's source columns and its number among equal lines."""
    key = natural_key("nocom", "produit_key", "prixunit", "qte", F.col("remise").cast(DETAILCOMMANDE["remise"].dataType), "copie")
    return lines.select(key.alias("ventes_key"), *[c for c in lines.columns if c != "copie"])


def sales_lines(detail: DataFrame, deliveries: DataFrame, dim_produit: DataFrame,
                produit: Mapping[str, str] = {}, more: Iterable[str] = ()) -> DataFrame:
    """The sales fact with ``copie`` in place of its key, which a load computes after it has dealt the rows."""
    lines = _known(numbered_lines(detail), dim_produit, "refprod", produit)
    header = deliveries.select(
        "nocom", F.col("datecom_key").alias("date_key"), "client_key", "employe_key",
        "transporteur_key", "geo_key", "port", "total_net", "annee", *more)
    # amounts after the join: its exchange carries the source columns only
    enriched = line_amounts(lines.join(header, "nocom"), [*header.columns[1:], "copie", *[c for c in produit if c != "refprod"]])
    return enriched.select(
        "date_key", "client_key", "employe_key", "transporteur_key",
        F.col("refprod").alias("produit_key"), "geo_key", "nocom", "qte", "prixunit",
        F.col("remise").cast(RATE).alias("remise"),
        F.col("montant_brut").cast(AMOUNT).alias("montant_brut"),
        F.col("montant_net").cast(AMOUNT).alias("montant_net"),
        allocated_freight().alias("port_alloc"),
        "copie", "annee", *produit, *more,
    )
