"""Exact deduplication by one or several keys, and of similar curves."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curveloom.functions import text as X


def first_wins(rows: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order. Rows are compared by aggregation, which combines before the shuffle."""
    names = rows.columns
    keyed = rows.select(F.struct(*order).alias("__o"), F.struct(*names).alias("__r"), *[k.alias(f"__k{i}") for i, k in enumerate(keys)])
    best = keyed.groupBy(*[f"__k{i}" for i in range(len(keys))]).agg(F.min_by("__r", "__o").alias("__r"))
    return best.select(*[F.col("__r")[n].alias(n) for n in names])


def work_keys(doi: Column, work_id: Column, title: Column) -> Column:
    """Up to three keys of an article: doi:, openalex: and title:, each only if it is known."""
    parts = (("doi:", X.normalize_doi(doi)), ("openalex:", X.or_null(X.short_id(work_id))), ("title:", X.or_null(X.normalize_title(title))))
    return F.filter(F.array(*[F.concat(F.lit(p), v) for p, v in parts]), lambda k: k.isNotNull())


def key_groups(rows: DataFrame, id_col: str, keys: str, rounds: int = 50) -> DataFrame:
    """(id, group) of rows(id, array of keys): rows that share a key, also through others, form a group named by its smallest id.

    Labels travel from rows to keys and back by grouped minima until none changes; lineage is cut by checkpoints. All joins are
    merged: rows are estimated from their files, which may be many times smaller, so Spark would broadcast tables that fill the driver.
    """
    links = rows.select(F.col(id_col).alias("id"), F.explode_outer(keys).alias("key")).distinct().checkpoint()
    label = links.select("id", F.col("id").alias("group")).distinct().checkpoint()
    for _ in range(rounds):
        by_key = links.where("key is not null").join(label.hint("merge"), "id").groupBy("key").agg(F.min("group").alias("g"))
        pulled = links.join(by_key.hint("merge"), "key").groupBy("id").agg(F.min("g").alias("g"))
        moved = label.join(pulled.hint("merge"), "id", "left").select("id", F.least("group", F.coalesce("g", "group")).alias("group"))
        # The group of the group: chains halve in every round.
        parent = moved.select(F.col("id").alias("group"), F.col("group").alias("up"))
        moved = moved.join(parent.hint("merge"), "group", "left").select("id", F.coalesce("up", "group").alias("group")).checkpoint()
        if not moved.join(label.withColumnRenamed("group", "was").hint("merge"), "id").where("`group` <> was").limit(1).count():
            return moved
        label = moved
    raise RuntimeError("groups did not settle")


def keep_best(rows: DataFrame, id_col: str, keys: Column, order: Sequence[Column]) -> DataFrame:
    """The first row in `order` of each group of rows that share a key. Ties go to the smallest id."""
    marked = rows.withColumn("__keys", keys)
    groups = key_groups(marked, id_col, "__keys").select(F.col("id").alias("__id"), F.col("group").alias("__group"))
    joined = marked.join(groups.hint("merge"), F.col(id_col) == F.col("__id"))
    best = F.row_number().over(W.partitionBy("__group").orderBy(*order, id_col))
    return joined.withColumn("__k", best).where("__k = 1").select(*rows.columns)


def existing_match(rows: DataFrame, id_col: str, keys: Column, saved: DataFrame, saved_keys: Column, saved_id: str) -> DataFrame:
    """id_col and `match` of the rows that a saved row shares a key with: the smallest saved id of the first key, in the order of
    `keys`, that any saved row has."""
    known = saved.select(F.col(saved_id).alias("__saved"), F.explode(saved_keys).alias("__key")).groupBy("__key").agg(F.min("__saved").alias("__saved"))
    asked = rows.select(F.col(id_col).alias(id_col), F.posexplode(keys).alias("__rank", "__key"))
    return asked.join(known, "__key").groupBy(id_col).agg(F.min_by("__saved", "__rank").alias("match"))


def unseen(rows: DataFrame, id_col: str, keys: Column, saved: DataFrame, saved_keys: Column) -> DataFrame:
    """rows that share no key with a saved row; rows without a key are unseen."""
    known = saved.select(F.explode(saved_keys).alias("__key")).distinct()
    met = rows.select(F.col(id_col).alias("__id"), F.explode(keys).alias("__key")).join(known, "__key", "left_semi").select("__id").distinct()
    return rows.join(met, F.col(id_col) == F.col("__id"), "left_anti")


def keep_best_in_order(rows: DataFrame, group: Sequence[str], order: str, keys: str, score: str, schema: str) -> DataFrame:
    """The sequential rule inside each group: a row that meets a stored one by its first known key replaces it if it scores more.

    Unlike keep_best the result depends on the order and two stored rows are never merged. A group is read by one task.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kept: dict[int, tuple] = {}
        owner: dict[str, int] = {}
        for at, (own, points) in enumerate(zip(pdf[keys], pdf[score])):
            met = next((owner[k] for k in own if k in owner), None)
            if met is not None:
                if points <= kept[met][1]:
                    continue
                del kept[met]
                owner = {k: i for k, i in owner.items() if i != met}
            kept[at] = (own, points)
            owner.update(dict.fromkeys(own, at))
        return pdf.iloc[sorted(kept)]

    return rows.groupBy(*group).applyInPandas(lambda pdf: run(pdf.sort_values(order, kind="stable").reset_index(drop=True)), schema)


def distinct_curves(curves: DataFrame, group: Sequence[str], order: str, values: str, limit: float = 0.92) -> DataFrame:
    """Curves of a group, in order, that correlate above the limit with no kept one of their length."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        kept: list[tuple[int, np.ndarray]] = []
        for at, y in enumerate(pdf[values]):
            y = np.asarray(y, float)
            unit = y - y.mean() if len(y) else y
            size = np.linalg.norm(unit)
            unit = unit / size if size > 0 else np.zeros_like(unit)
            if not any(len(k) == len(unit) and float(k @ unit) > limit for _, k in kept):
                kept.append((at, unit))
        return pdf.iloc[[at for at, _ in kept]]

    return curves.groupBy(*group).applyInPandas(run, curves.schema)
