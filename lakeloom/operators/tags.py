"""Tags of posts: exploded, canonicalised, counted, looked up in a dictionary, ranked.

Counts come from the table itself in one grouped aggregate that combines before
the shuffle, so a tag on a third of all posts costs one row for each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .joins import rename_map, with_dictionary

POLICIES = ("overwrite_always", "overwrite_found", "overwrite_category", "first_sight", "fill_id", "coalesce", "embedded", "ttl_budget")


def exploded(posts: DataFrame, post: str, tags: Column, distinct: bool = True) -> DataFrame:
    """A row of ``post`` and ``tag`` for each tag of a post; with ``distinct`` each tag of a post once."""
    return posts.select(post, F.explode(F.array_distinct(tags) if distinct else tags).alias("tag"))


def canonical(tagged: DataFrame, mapping: DataFrame, post: str) -> DataFrame:
    """Tags under their present names; a post that has both names of a tag has it once."""
    return rename_map(tagged, mapping).select(post, "tag").distinct()


def usage(tagged: DataFrame, keys: tuple[str, ...] = ("tag",)) -> DataFrame:
    """Uses for each key."""
    return tagged.groupBy(*keys).agg(F.count("*").alias("n"))


def strict_usage(tagged: DataFrame, primary: Column) -> DataFrame:
    """Uses of each tag as a post's primary tag and otherwise."""
    yes = F.coalesce(primary, F.lit(False)).cast("long")
    return tagged.groupBy("tag").agg(F.sum(yes).alias("n_primary"), F.sum(1 - yes).alias("n_other"))


def merged_totals(totals: DataFrame, mapping: DataFrame) -> DataFrame:
    """Totals (``tag``, ``n``) after renames: those of the old and the new name add up."""
    return rename_map(totals, mapping).groupBy("tag").agg(F.sum("n").alias("n"))


def by_category(posts: DataFrame, post: str, tags: Column) -> DataFrame:
    """``post``, ``category``, ``tag`` of a map from category to list of tags."""
    return posts.select(post, F.explode(tags).alias("category", "list")).select(post, "category", F.explode("list").alias("tag"))


def top_n_per_type(counts: DataFrame, kind: str, n: int = 30, count: str = "n", name: str = "tag") -> DataFrame:
    """The ``n`` most used tags of each type with ``rank``, ties by name. ``counts`` has a row for each tag, and the ranking keeps n rows of a type before its shuffle."""
    order = Window.partitionBy(kind).orderBy(F.col(count).desc_nulls_last(), F.col(name).asc_nulls_last())
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def refresh(stored: DataFrame, seen: DataFrame, dictionary: DataFrame, policy: str, asof: Column | None = None, ttl_days: int = 365, budget: int = 300) -> DataFrame:
    """The tag table after a run that saw ``seen`` (tag, n), under one of ``POLICIES``.

    ``stored`` has tag, id, type, total, n and, for ``ttl_budget``, refreshed
    (timestamp); ``dictionary`` has tag, id, type, total. Uses ``n`` add up in
    every policy; the attributes id, type and total follow the policy:

    - overwrite_always: the dictionary's, or -1, -1, 0 where it has no entry;
    - overwrite_found: the dictionary's where it has one, else as before;
    - overwrite_category: the same where its type isn't -1;
    - first_sight: never change once stored;
    - fill_id: the id only where it was -1, the total always where found;
    - coalesce: each attribute that the dictionary knows;
    - embedded: the dictionary (here: objects seen with the posts) always wins;
    - ttl_budget: refreshed where older than ``ttl_days`` at ``asof``, oldest
      first, at most ``budget`` tags a run (the budget is the feature).

    A tag stored nowhere gets the dictionary's attributes or the defaults.
    """
    if policy not in POLICIES:
        raise ValueError(f"no such policy: {policy}")
    attributes = ("id", "type", "total")
    defaults = {"id": -1, "type": -1, "total": -1 if policy == "fill_id" else 0}
    s = stored.select(F.col("tag").alias("_st"), *(F.col(a).alias(f"_s_{a}") for a in attributes), F.col("n").alias("_sn"), *([F.col("refreshed").alias("_at")] if policy == "ttl_budget" else []))
    d = dictionary.select(F.col("tag").alias("_dt"), *(F.col(a).alias(f"_d_{a}") for a in attributes))
    both = s.join(seen.select("tag", F.col("n").alias("_nn")), F.col("_st") == F.col("tag"), "full_outer").withColumn("tag", F.coalesce("tag", "_st")).join(d, F.col("tag") == F.col("_dt"), "left")
    known, found, used = F.col("_st").isNotNull(), F.col("_dt").isNotNull(), F.col("_nn").isNotNull()
    if policy == "ttl_budget":
        due = known & used & (F.col("_at").isNull() | (F.col("_at") + F.expr(f"INTERVAL {ttl_days} DAYS") < asof))
        turns = both.where(due).select(F.col("tag").alias("_due"), "_at").orderBy(F.col("_at").asc_nulls_first(), "tag").limit(budget).select("_due", F.lit(True).alias("_turn"))
        both = both.join(turns, F.col("tag") == F.col("_due"), "left")
    out = []
    for a in attributes:
        old, new, default = F.col(f"_s_{a}"), F.col(f"_d_{a}"), F.lit(defaults[a])
        fresh = F.coalesce(new, default)
        value = {
            "overwrite_always": lambda: F.when(used, fresh).otherwise(old),
            "overwrite_found": lambda: F.when(used & found, fresh).otherwise(old),
            "overwrite_category": lambda: F.when(used & found & (F.col("_d_type") != -1), fresh).otherwise(old),
            "first_sight": lambda: old,
            "fill_id": lambda: F.when(used & found & (F.lit(a == "total") | ((F.lit(a) == "id") & (old == -1))), fresh).otherwise(old),
            "coalesce": lambda: F.when(used, F.coalesce(new, old)).otherwise(old),
            "embedded": lambda: F.when(found, F.coalesce(new, old)).otherwise(old),
            "ttl_budget": lambda: F.when(F.col("_turn") & found, fresh).otherwise(old),
        }[policy]()  # noqa: B023
        out.append(F.when(known, value).otherwise(fresh).alias(a))
    return both.select("tag", *out, (F.coalesce("_sn", F.lit(0)) + F.coalesce("_nn", F.lit(0))).cast("long").alias("n"))


def enriched(tagged: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``tagged`` with the dictionary's id, type and ambiguity; -1, -1 and false without an entry."""
    return with_dictionary(tagged, dictionary, ["tag"], {"id": -1, "type": -1, "ambiguous": False})
