"""The two table sets: the source system (``Oltp``) and the star schema (``Mart``).

Both are frozen bags of DataFrames; building or reading them is lazy.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a dimension, by the name they get.
Attributes = Mapping[str, str]


@dataclass(frozen=True)
class Oltp:
    categorie: DataFrame
    fournisseur: DataFrame
    client: DataFrame
    employe: DataFrame
    transporteur: DataFrame
    produit: DataFrame
    commande: DataFrame
    detailcommande: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(Oltp)}


@dataclass(frozen=True)
class Mart:
    dim_temps: DataFrame
    dim_client: DataFrame
    dim_employe: DataFrame
    dim_transporteur: DataFrame
    dim_geo: DataFrame
    dim_produit: DataFrame
    fait_livraisons: DataFrame
    fait_ventes: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(Mart)}

    def sales_of(self, produit: Attributes, client: Attributes, employe: Attributes) -> DataFrame:
        """The sales lines with attributes of their product, customer and employee."""
        lines = self.fait_ventes
        for dim, key, wanted in ((self.dim_produit, "produit_key", produit), (self.dim_client, "client_key", client),
                                 (self.dim_employe, "employe_key", employe)):
            lines = lines.join(dim.select(key, *[F.col(c).alias(n) for n, c in wanted.items()]), key)
        return lines


@dataclass(frozen=True)
class BuiltMart(Mart):
    """A mart that is still a plan over the sources.

    Each member is looked up once on the way to a line: the joins that drop rows without
    a product, customer or employee bring the attributes along, those of customer and employee at
    order grain. No line is shuffled again, by a key of 16 bytes, to meet a dimension.
    """

    #: ``fait_ventes`` with attributes, and the two facts it goes with: a mart whose facts were replaced (a slicer) joins by key.
    attributed: Callable[[Attributes, Attributes, Attributes], DataFrame]
    built: tuple[DataFrame, DataFrame]

    def sales_of(self, produit: Attributes, client: Attributes, employe: Attributes) -> DataFrame:
        if self.built[0] is self.fait_livraisons and self.built[1] is self.fait_ventes:
            return self.attributed(produit, client, employe)
        return super().sales_of(produit, client, employe)
