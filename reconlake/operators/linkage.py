"""Joins of records: cascades, containment through an index, blocked best match, nearest preceding."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reconlake.functions.text import seq_ratio
from reconlake.operators import nearest
from reconlake.session import cut, joined


def cascade(left: DataFrame, right: DataFrame, left_id: str, right_id: str, strict: str, loose: str, place: str, least: int = 5) -> DataFrame:
    """(left_id, right_id, level): matches at the first level that hits.

    Levels: 1 strict key in the place, 2 loose key in the place, 3 strict key if it is unique anywhere, 4 loose key of at
    least `least` characters if unique anywhere. Both tables have the columns strict, loose and place. Null and empty
    keys match nothing. The four keys of a row are one column, so both tables are joined once.
    """
    def keyed(df: DataFrame, i: str) -> DataFrame:
        no_place = F.col(place).isNull() | (F.col(place) == "")
        keys = [(1, strict, ~no_place), (2, loose, ~no_place), (3, strict, F.lit(True)), (4, loose, F.length(loose) >= least)]
        row = [
            F.when(F.col(k).isNotNull() & (F.col(k) != "") & ok, F.struct(F.lit(level).alias("level"), F.col(k).alias("k"), (F.col(place) if level < 3 else F.lit("")).alias("p")))
            for level, k, ok in keys
        ]
        return df.select(F.col(i), F.explode(F.array_compact(F.array(*row))).alias("_c")).select(i, "_c.*")

    r = cut(keyed(right, right_id))  # read for the places and for the unique keys
    alone = r.where("level >= 3").groupBy("level", "k", "p").agg(F.min(right_id).alias(right_id), F.count("*").alias("_n")).where("_n = 1").select(right_id, "level", "k", "p")
    hits = keyed(left, left_id).join(r.where("level < 3").unionByName(alone), ["level", "k", "p"]).select(left_id, right_id, "level")
    first = F.min("level").over(Window.partitionBy(left_id))
    return hits.withColumn("_f", first).where("level = _f").select(left_id, right_id, "level").distinct()


def containment(left: DataFrame, right: DataFrame, left_id: str, right_id: str, key: str, block: str, least: int = 5) -> DataFrame:
    """(left_id, right_id, kind): keys equal, or the shorter (of at least `least` characters) inside the longer, in one block.

    A contained key starts with a gram of `least` characters that the longer key has somewhere: the join is on
    (block, gram), never on the block alone, and the containment itself is checked on the pairs left.
    """
    def grams(df: DataFrame, i: str, name: str) -> DataFrame:
        g = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(key) - least + 1), lambda p: F.substring(key, p, F.lit(least))))
        return df.where(F.length(key) >= least).select(F.col(i), block, F.col(key).alias(name), F.explode(g).alias("_g"))

    def heads(df: DataFrame, i: str, name: str) -> DataFrame:
        return df.where(F.length(key) >= least).select(F.col(i), block, F.col(key).alias(name), F.substring(key, 1, least).alias("_g"))

    a = heads(left, left_id, "_a").join(grams(right, right_id, "_b"), [block, "_g"]).where(F.contains("_b", "_a"))
    b = grams(left, left_id, "_a").join(heads(right, right_id, "_b"), [block, "_g"]).where(F.contains("_a", "_b"))
    kind = F.when(F.col("_a") == F.col("_b"), "equal").otherwise("contained")
    return a.unionByName(b).select(left_id, right_id, kind.alias("kind")).distinct()


def best_in_block(left: DataFrame, right: DataFrame, left_id: str, right_id: str, block: list[str], score: Column, least: float) -> DataFrame:
    """(left_id, right_id, score): each left row's best right row of its block; ties go to the lower right_id."""
    p = left.join(right, block).withColumn("score", score).where(F.col("score") >= least)
    first = F.row_number().over(Window.partitionBy(left_id).orderBy(F.desc("score"), right_id))
    return p.withColumn("_r", first).where("_r = 1").select(left_id, right_id, "score")


def _grams(key: str) -> Column:
    """Hashes of the characters of a key; repeats are numbered, so that none is equal to another."""
    g = F.transform(F.sequence(F.lit(1), F.length(key)), lambda p: F.substring(key, p, F.lit(1)))
    # the grams are an argument of the outer function, so that they are computed once
    once = F.transform(F.array(g), lambda a: F.transform(a, lambda x, i: F.xxhash64(x, F.size(F.filter(F.slice(a, F.lit(1), i + 1), lambda y: y == x)))))
    return once[0]


def best_in_place(left: DataFrame, right: DataFrame, left_id: str, right_id: str, kind: str, least: float) -> DataFrame:
    """(left_id, right_id, score): each left row's best right row of its place by edit distance ("edit") or Ratcliff-Obershelp ("ratio").

    left has lk and place, right rk and place; an unknown place meets all. `least` is over 0.5. Ties go to the lower right_id; null
    keys match nothing. Equal keys are joined first. The others are searched within their place, and then among the rights of
    unknown place with what they found as a score to reach (nearest.search); each distinct key is searched once.
    """
    lefts = left.where("lk <> ''").select("lk", "place").distinct()
    rights = right.where("rk <> ''").groupBy("rk", "place").agg(F.min(right_id).alias(right_id))
    placed = F.concat(F.lit("="), "place")
    rs = rights.select("rk", right_id, F.explode(F.array(F.coalesce(placed, F.lit("?")), F.lit("*"))).alias("slot"))
    rs = cut(rs.groupBy("slot", "rk").agg(F.min(right_id).alias(right_id)))  # "?": of unknown place, "*": all
    l_slots = F.when(F.col("place").isNull(), F.array(F.lit("*"))).otherwise(F.array(placed, F.lit("?")))
    first = Window.partitionBy("lk", "place").orderBy(F.desc("score"), right_id)
    best = lambda pairs: pairs.withColumn("_r", F.row_number().over(first)).where("_r = 1").select("lk", "place", right_id, "score")
    same = joined(lefts.withColumn("slot", F.explode(l_slots)), rs.withColumnRenamed("rk", "lk"), ["slot", "lk"])
    equal = cut(best(same.select("lk", "place", right_id, F.lit(1.0).alias("score"))))
    rest = cut(joined(lefts, equal.select(F.col("lk").alias("_k"), F.col("place").alias("_p")), (F.col("lk") == F.col("_k")) & F.col("place").eqNullSafe(F.col("_p")), "left_anti"))

    def each(l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if l.empty or r.empty:
            return pd.DataFrame({"lk": [], "place": [], right_id: [], "score": []})
        r = r.sort_values(right_id)
        score, at = nearest.best_texts(l["lk"].tolist(), r["rk"].tolist(), l["s"].to_numpy(float), kind)
        ok = at < len(r)
        return pd.DataFrame({"lk": l["lk"][ok], "place": l["place"][ok], right_id: r[right_id].to_numpy()[at[ok]], "score": score[ok]})

    schema = f"lk string, place string, {right_id} {dict(right.dtypes)[right_id]}, score double"
    searched = lambda l: nearest.in_cells(l, rs, "slot", each, schema)
    near = cut(searched(rest.where("place is not null").select("lk", "place", F.lit(least).alias("s"), placed.alias("slot"))))
    known = near.select(F.col("lk").alias("_k"), F.col("place").alias("_p"), F.col("score").alias("_s"))
    beat = joined(rest, known, (F.col("lk") == F.col("_k")) & F.col("place").eqNullSafe(F.col("_p")), "left")
    far = searched(beat.select("lk", "place", F.coalesce("_s", F.lit(least)).alias("s"), F.when(F.col("place").isNull(), "*").otherwise("?").alias("slot")))
    found = equal.unionByName(best(near.unionByName(far))).select(F.col("lk").alias("_k"), F.col("place").alias("_p"), right_id, "score")
    out = joined(left, found, (F.col("lk") == F.col("_k")) & F.col("place").eqNullSafe(F.col("_p")))
    return out.select(left_id, right_id, "score")


def pairs_in_place(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(lk, rk, score): distinct pairs of keys of one place (an unknown one meets all) whose Ratcliff-Obershelp similarity is at least `least`.

    left has lk and place, right rk and place. Keys meet only through one of their rarer characters: of the common
    characters that the score needs, one must be among them, so no pair is lost and no block is paired out.
    """
    low = least - 1e-4
    ls, rs = ((df.where(f"{k} <> ''").select(F.col(k), "place").distinct()) for df, k in ((left, "lk"), (right, "rk")))
    keys = ls.select(F.col("lk").alias("k")).union(rs.select("rk")).distinct()
    tokens = keys.select("k", F.explode(_grams("k")).alias("g"))
    df = tokens.groupBy("g").agg(F.count("*").alias("df"))
    ordered = cut(tokens.join(df, "g").groupBy("k").agg(F.transform(F.sort_array(F.collect_list(F.struct("df", "g"))), lambda x: x.g).alias("gs")))
    prefix = (F.size("gs") - F.greatest(F.ceil(F.size("gs") * low / (2 - low) - 1e-9), F.lit(1)) + 1).cast("int")

    def side(df: DataFrame, k: str, slots: Column, name: str) -> DataFrame:
        rows = df.join(ordered, F.col(k) == F.col("k")).select(k, F.explode(slots).alias("slot"), F.col("gs").alias(name), F.posexplode(F.slice("gs", F.lit(1), prefix)).alias(f"{name}_at", "g"))
        return rows

    l = side(ls, "lk", F.when(F.col("place").isNull(), F.array(F.lit("*"))).otherwise(F.array(F.col("place"), F.lit("?"))), "lgs")
    r = side(rs, "rk", F.array(F.coalesce("place", F.lit("?")), F.lit("*")), "rgs")
    need = F.ceil(low * (F.size("lgs") + F.size("rgs")) / 2 - 1e-9)
    common = F.least(F.size("lgs") - F.col("lgs_at"), F.size("rgs") - F.col("rgs_at"))
    p = l.join(r, ["slot", "g"]).where(common >= need).where(F.size(F.array_intersect("lgs", "rgs")) >= need).select("lk", "rk").distinct()
    return p.withColumn("score", ratio_score("lk", "rk")).where(F.col("score") >= least)


def best_by_two_names(left: DataFrame, right: DataFrame, left_id: str, right_id: str, least: float = 0.62, least_name: float = 0.5, others: bool = False) -> DataFrame:
    """(left_id, right_id, score, name_score, what_score): each left row's best right row of its kind and place by two texts.

    Both tables have kind, place, name and what (a treatment, say) as keys in normal form; kinds are equal, an unknown
    place meets all. The score is 0.44 of the similarity of names and 0.56 of that of the other text, plus 0.12 for equal
    names or 0.05 for one inside the other, and 0.10 for equal other texts, at most 1. Names that are less alike than
    least_name match nothing. Ties go to the lower right_id. With `others` the ids of both tables are of one list and a row
    meets all but its own. Equal rows of a side are searched once (nearest.search), except those whose own id could be a
    match; no pairs are written but the best of each.
    """
    key = ["kind", "place", "name", "what"]
    usable = lambda df: df.where("kind is not null and name <> '' and what is not null")
    slot = lambda of: F.concat(F.col("kind").cast("string"), F.lit("\u001f"), of)
    placed = F.concat(F.lit("="), F.col("place").cast("string"))
    rs = usable(right).select(*key, right_id).withColumn("slot", F.explode(F.array(slot(F.coalesce(placed, F.lit("?"))), slot(F.lit("*")))))
    rs = rs.select("slot", F.col("name").alias("rk"), F.col("what").alias("rw"), right_id)
    first_of = lambda df: df.groupBy("slot", "rk", "rw").agg(F.min(right_id).alias(right_id))
    own = F.lit(None).cast("string")
    if others:  # of equal rows the two lowest ids, as one of them may be the row's own
        lowest = cut(first_of(rs))
        same = joined(rs, lowest.withColumnRenamed(right_id, "_f"), ["slot", "rk", "rw"])
        rs = cut(lowest.unionByName(first_of(same.where(F.col(right_id) > F.col("_f")))))
        lefts = usable(left).select(left_id, *key)
        shown = rs.select(F.col(right_id).alias(left_id), F.col(right_id).cast("string").alias("_own")).distinct()
        lefts = cut(joined(lefts, shown, left_id, "left"))
    else:
        rs = first_of(rs)
        lefts = left.select(left_id, *key, own.alias("_own"))
    ls = usable(lefts).select(*key, "_own").distinct()
    ls = ls.withColumn("slot", F.explode(F.when(F.col("place").isNull(), F.array(slot(F.lit("*")))).otherwise(F.array(slot(placed), slot(F.lit("?"))))))
    rs = rs.withColumn("_id", F.col(right_id).cast("string"))
    names = [*key, "_own", right_id, "score", "name_score", "what_score"]

    def each(l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if l.empty or r.empty:
            return pd.DataFrame({c: [] for c in names})
        r = r.sort_values(right_id)
        ids = None
        if others:
            codes = pd.factorize(pd.concat([l["_own"], r["_id"]], ignore_index=True))[0]  # -1 for none
            ids = codes[: len(l)], codes[len(l) :]
        score, at, by_name, by_what = nearest.best_by_two(l["name"].tolist(), l["what"].tolist(), r["rk"].tolist(), r["rw"].tolist(), least, least_name, ids)
        ok = at < len(r)
        return pd.DataFrame({**{c: l[c][ok] for c in (*key, "_own")}, right_id: r[right_id].to_numpy()[at[ok]], "score": score[ok], "name_score": by_name, "what_score": by_what})[names]

    types = dict(left.dtypes) | {right_id: dict(right.dtypes)[right_id], "_own": "string"}
    found = nearest.in_cells(ls, rs, "slot", each, ", ".join(f"{c} {types.get(c, 'double') if c in (*key, '_own', right_id) else 'double'}" for c in names))
    first = F.row_number().over(Window.partitionBy(*key, "_own").orderBy(F.desc("score"), right_id))
    found = found.withColumn("_r", first).where("_r = 1").drop("_r").withColumnsRenamed({c: f"_{c}" for c in (*key, "_own")})
    same = (F.col("kind") == F.col("_kind")) & F.col("place").eqNullSafe(F.col("_place")) & (F.col("name") == F.col("_name")) & (F.col("what") == F.col("_what"))
    same = same & F.col("_own").eqNullSafe(F.col("__own"))
    return lefts.join(found, same).select(left_id, right_id, "score", "name_score", "what_score")


def matches_by_name_or_address(left: DataFrame, right: DataFrame, left_id: str, right_id: str, name: str, address: str, place: str, least_name: int = 5, least_address: int = 8) -> DataFrame:
    """(left_id, right_id, name_score, address_score, score): pairs of one place that agree by name or by address.

    100 for equal keys, 92 for a name (of at least least_name characters) inside the other, 96 for an address (of at
    least least_address) inside the other, 0 for none; score is the better one.
    """
    def pairs(key: str, least: int, contained: int, out: str) -> DataFrame:
        both = [df.where(f"{key} <> ''").select(i, place, key) for df, i in ((left, left_id), (right, right_id))]
        equal = both[0].join(both[1], [place, key]).select(left_id, right_id, F.lit(100).alias(out))
        inside = containment(left.where(f"{key} <> ''"), right.where(f"{key} <> ''"), left_id, right_id, key, place, least)
        return equal.unionByName(inside.select(left_id, right_id, F.when(F.col("kind") == "equal", 100).otherwise(contained).alias(out)))

    n, a = pairs(name, least_name, 92, "name_score"), pairs(address, least_address, 96, "address_score")
    both = n.unionByName(a, allowMissingColumns=True).groupBy(left_id, right_id).agg(
        F.coalesce(F.max("name_score"), F.lit(0)).cast("bigint").alias("name_score"), F.coalesce(F.max("address_score"), F.lit(0)).cast("bigint").alias("address_score")
    )
    return both.withColumn("score", F.greatest("name_score", "address_score"))


def enriched_by_alias(left: DataFrame, known: DataFrame, left_id: str, key: str, place: str, values: str, least: int = 6) -> DataFrame:
    """left with `values`: its own and, sorted, those of all known rows of its place whose key is equal to its key, or, from `least` characters, inside or around it."""
    k = known.withColumn("_known", F.xxhash64(key, place, F.to_json(F.array_sort(values))))
    same = left.select(left_id, place, key).join(k.select("_known", place, key), [place, key]).select(left_id, "_known")
    near = containment(left, k, left_id, "_known", key, place, least).select(left_id, "_known")
    found = same.unionByName(near).distinct().join(k.select("_known", F.explode(values).alias("_v")).distinct(), "_known").groupBy(left_id).agg(F.collect_set("_v").alias("_found"))
    empty = F.array().cast("array<string>")
    out = left.join(found, left_id, "left")
    return out.withColumn(values, F.array_sort(F.array_union(F.coalesce(values, empty), F.coalesce("_found", empty)))).drop("_found")


def flagged(df: DataFrame, keys: list[str], known: dict[str, DataFrame]) -> DataFrame:
    """df with one boolean a table of `known`: whether the row's keys occur there; null keys never do."""
    for name, other in known.items():
        df = df.join(other.select(*keys).distinct().withColumn(name, F.lit(True)), keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return df


def best_at_address(left: DataFrame, right: DataFrame, left_id: str, right_id: str, address: str, name: str) -> DataFrame:
    """(left_id, right_id, score): of the right rows at the same address the one with the most similar name; ties to the lower right_id.

    Equal names of an address are scored once; both tables have the columns address and name.
    """
    l = left.where(f"{address} <> ''").select(address, F.col(name).alias("lk")).distinct()
    r = right.where(f"{address} <> ''").groupBy(address, F.col(name).alias("rk")).agg(F.min(right_id).alias(right_id))
    p = l.join(r, address).withColumn("score", F.round(ratio_score("lk", "rk"), 4))
    first = F.row_number().over(Window.partitionBy(address, "lk").orderBy(F.desc("score"), right_id))
    best = p.withColumn("_r", first).where("_r = 1").select(address, F.col("lk").alias(name), right_id, "score")
    return left.select(left_id, address, name).join(best, [address, name]).select(left_id, right_id, "score")


def ratio_score(a: str, b: str) -> Column:
    """Ratcliff-Obershelp similarity; exact keys should be joined before, as it runs in Python."""
    return F.when(F.col(a) == F.col(b), 1.0).otherwise(seq_ratio(a, b))


def preceding(df: DataFrame, key: str, order: list[str], value: Column, name: str, reach: int | None = None, own: bool = False) -> DataFrame:
    """df with the last non-null value of the rows before, within the key; of the last `reach` rows if given, own row included if so."""
    first = Window.unboundedPreceding if reach is None else -reach
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(first, 0 if own else -1)
    return df.withColumn(name, F.last(value, True).over(w))


def running_group(df: DataFrame, key: str, order: list[str], starts: Column, name: str) -> DataFrame:
    """df with a group number that goes up at each row that starts a group."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(starts.cast("bigint")).over(w))
