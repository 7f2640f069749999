"""Variant spellings of names typed by people: records that mean the same facility at the same place (problem 2).

Method: names are brought to a rough sound (kanji by readings learned from the records) and cut into q-grams; a
prefix-filtered set-similarity join, rarest grams first, finds candidates; each is verified by a soft weighted
similarity of name tokens, where rare tokens count more, under the condition that the addresses can be of one place.
Verified links are closed to groups.

Candidates. The relation of two addresses (full, part, slip, city, open) says which names can be one facility at all, so each
relation has its keys: records with a house number meet within quarter and first number, sharing a gram of their
prefixes for an overlap of NEAR, or the full address; a record without a number meets its municipality likewise; one
without a municipality meets its prefecture (an unknown one all), where names may differ by `edits` letters: cut into one
piece more than that, a name has a piece that its partner holds unspoilt, and near the same place (`pieces`, `probes`). The
last meet in one join and all others in another, as the driver's memory grows with the plan. Relations are decided
inside the join: pairs whose addresses disagree are never written.

Equal forms are joined once, as one form with its members, so a facility repeated in a third of all records stays one
row of the join. Records with a municipality meet only within it; records without one need almost equal names and
join a group only if a single group fits.

Records with a null or empty name link to nothing. Repeated records link to each other. Empty tables give no pair.
"""

from __future__ import annotations

from functools import cache
from itertools import pairwise

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from reconlake.llm import readings
from reconlake.llm.mapping import osa
from reconlake.llm.namekeys import address_parts, foreign_words, kanji_of, sound, split_name
from reconlake.session import cut, joined, ship_package

Q = 3  # length of grams
NEAR = 0.3  # share of the larger set of grams that two names of one municipality have in common
CONTRAST = 3  # pairs of each form drawn for contrast
FAR = 2  # letters by which the lengths of two names may differ where one side names no municipality
#: edits of sounds shorter than the first number, and where these are cut, as shares of their length; words that many names share stand at the ends, so these pieces are longer
CUTS = [(6, 0, (0,)), (10, 1, (0, 0.5)), (18, 2, (0, 0.33, 0.53)), (float("inf"), 4, (0, 0.28, 0.44, 0.56, 0.72))]
BRAND_CITIES = 3  # a foreign word that stands in names of so many municipalities is a brand
STANDS_OUT, EXACT, CLOSER = 0.08, 0.985, 0.015  # lead over the next group that decides; less is enough for a name as good as equal
#: least name score by how far the addresses agree: full number, shared beginning, a slip in the house number, municipality only
LEAST = {"full": 0.20, "part": 0.45, "slip": 0.60, "city": 0.62, "open": 0.92}
FIRM = ("full", "part", "slip")

_PLACE = StructType([StructField(n, StringType()) for n in ("pref", "city", "quarter", "nums")] + [StructField("foreign", ArrayType(StringType()))])
_NAME = StructType([StructField(n, StringType()) for n in ("corp", "brand", "stem", "area", "types", "han")])
_FAR_KEYS = StructType([StructField("keys", ArrayType(StringType())), StructField("bits", LongType())])
PLACES = ["pref", "city", "quarter", "nums"]
KEYS = ["corp", "brand", "snd", "area", "types", "han", *PLACES]


@F.pandas_udf(_PLACE)
def places(name: pd.Series, address: pd.Series, prefecture: pd.Series) -> pd.DataFrame:
    """Parts of the addresses, and the words of the names that may be brands."""
    text = lambda x: x if isinstance(x, str) else None
    rows = [(*address_parts(text(a), text(p)), foreign_words(text(n))) for n, a, p in zip(name, address, prefecture, strict=True)]
    return pd.DataFrame(rows, columns=_PLACE.names)


def grams(snd: Column, q: int) -> Column:
    """Distinct q-grams of a sound, its ends marked."""
    s = F.concat(F.lit("^"), snd, F.lit("$"))
    at = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(s) - q + 1))
    return F.array_distinct(F.transform(at, lambda i: F.substring(s, i, F.lit(q))))


def edits(length: Column) -> Column:
    """How many letters two sounds (the shorter of this length) may differ by where no municipality is stated on one side.

    More would fail the least score for open addresses.
    """
    out = F.lit(CUTS[-1][1])
    for most, e, _ in reversed(CUTS[:-1]):
        out = F.when(length < most, e).otherwise(out)
    return out


@cache
def borders(length: int) -> tuple[int, ...]:
    """Where the pieces of a sound of this length begin, one more than it may have edits, and the length itself."""
    shares = next(c for most, _, c in CUTS if length < most)
    return (*(int(length * c) for c in shares), length)


def pieces(snd: str) -> list[str]:
    """Keys of the pieces of a sound."""
    at = borders(len(snd))
    return [f"{len(snd)} {i} {snd[a:b]}" for i, (a, b) in enumerate(pairwise(at))]


def probes(snd: str) -> list[str]:
    """Keys of which a sound shares one with the pieces of every sound that is `edits` letters apart and FAR longer or shorter at most.

    Take the first piece i (from 0) up to whose end there are no more than i edits: it has none itself, and i stand before
    it, so it has moved by i letters at most; the edits behind it bound how far it has moved from the end.
    """
    n, out = len(snd), {}
    for length in range(max(1, n - FAR), n + FAR + 1):
        at = borders(length)
        behind, longer = len(at) - 2, n - length
        for i, (a, b) in enumerate(pairwise(at)):
            low, high = max(0, a - i, a + longer - behind + i), min(n - b + a, a + i, a + longer + behind - i)
            out |= {f"{length} {i} {snd[p : p + b - a]}": None for p in range(low, high + 1)}
    return list(out)


def bits(snd: str) -> int:
    """A bit for each hashed pair of neighbours; an edit changes four bits at most."""
    out = 0
    for x, y in pairwise(snd):
        out |= 1 << (ord(x) * 31 + ord(y)) % 63
    return out


@F.pandas_udf(_FAR_KEYS)
def far_keys(snd: pd.Series, probing: pd.Series) -> pd.DataFrame:
    """Keys by which sounds meet that may differ by `edits` letters: probes() of those that look for others, pieces() of the others; and bits()."""
    rows = [(probes(s) if p else pieces(s), bits(s)) for s, p in zip(snd, probing, strict=True)]
    return pd.DataFrame(rows, columns=_FAR_KEYS.names)


def records(df: DataFrame, key: str, name: str, address: str, prefecture: str | None = None) -> DataFrame:
    """(rec, name, address, prefecture) of one table."""
    pref = F.col(prefecture) if prefecture else F.lit(None)
    return df.select(F.col(key).cast("string").alias("rec"), F.col(name).alias("name"), F.col(address).alias("address"), pref.cast("string").alias("prefecture"))


def keyed(recs: DataFrame) -> DataFrame:
    """(rec, keys of name and address) of records(): brands and readings are learned from all of them."""
    ship_package(recs.sparkSession)
    first = cut(recs.select("rec", "name", places("name", "address", "prefecture").alias("p")).select("rec", "name", "p.*"))
    in_cities = first.where("city != ''").select("city", F.explode("foreign").alias("word")).distinct().groupBy("word").count()
    brands = frozenset(r.word for r in in_cities.where(F.col("count") >= BRAND_CITIES).select("word").collect())  # words spread over municipalities

    @F.pandas_udf(_NAME)
    def parsed(name: pd.Series) -> pd.DataFrame:
        out = []
        for n in name:
            corp, brand, stem, area, types = split_name(n if isinstance(n, str) else None, brands)
            out.append((corp, brand, stem, area, types, kanji_of(stem)))
        return pd.DataFrame(out, columns=_NAME.names)

    second = cut(first.select("rec", parsed("name").alias("n"), *PLACES).select("rec", "n.*", *PLACES))
    known = readings.learned(second)  # at most one reading a kanji

    @F.pandas_udf(StringType())
    def heard(stem: pd.Series) -> pd.Series:
        return pd.Series([sound(x, known) for x in stem], dtype=object)

    return second.withColumn("snd", heard("stem")).select("rec", *KEYS)


def forms_of(recs: DataFrame, **flags: Column) -> DataFrame:
    """Distinct forms with an id of their content and token weights, and for each flag whether any of their records has it."""
    named = recs.where("snd != ''")
    forms = named.groupBy(*KEYS).agg(*[F.bool_or(c).alias(n) for n, c in flags.items()]) if flags else named.select(*KEYS).distinct()
    forms = forms.withColumn("form", F.xxhash64(*KEYS))
    forms = cut(forms)
    total = forms.count()
    token = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("v")) for k in ("corp", "brand", "snd", "area", "types")]))
    counts = forms.select(token.alias("t")).groupBy("t.k", "t.v").count()
    weights = (
        joined(forms.select("form", token.alias("t")).select("form", "t.k", "t.v").where("v != ''"), counts, ["k", "v"]).groupBy("form")
        .agg(F.map_from_entries(F.collect_list(F.struct("k", F.log((F.lit(total) + 1.0) / F.col("count")) + 0.5))).alias("w"))
    )
    return joined(forms, weights, "form")


def ordered_grams(forms: DataFrame) -> DataFrame:
    """(form, gs): the grams of each form, rarest first."""
    g = forms.select("form", F.explode(grams(F.col("snd"), Q)).alias("gram"))
    df = g.groupBy("gram").agg(F.count("*").alias("df"))
    both = joined(g, df, "gram").groupBy("form").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("of"))
    return both.select("form", F.transform("of", lambda x: x["gram"]).alias("gs"))


def relation(a: str, b: str) -> Column:
    """How far two addresses agree: full, part, slip, city, open or apart; a and b prefix the columns pref, city, quarter and nums."""
    c = lambda s, k: F.col(f"{s}_{k}")
    same_pref = (c(a, "pref") == "") | (c(b, "pref") == "") | (c(a, "pref") == c(b, "pref"))
    x, y, qa, qb = c(a, "nums"), c(b, "nums"), c(a, "quarter"), c(b, "quarter")
    # numbers are compared as texts, as arrays are slow in a join
    size = lambda v: F.when(v == "", 0).otherwise(F.length(v) - F.length(F.replace(v, F.lit("-"), F.lit(""))) + 1)
    first = lambda v, w: F.startswith(F.concat(v, F.lit("-")), F.concat(w, F.lit("-")))
    n = F.least(size(x), size(y))
    agree = (n == 0) | first(x, y) | first(y, x)
    slip = (n == 3) & (qa == qb) & (F.substring_index(x, "-", 2) == F.substring_index(y, "-", 2)) & (x != y)
    wider = ((x == "") & F.startswith(qb, qa)) | ((y == "") & F.startswith(qa, qb))
    inside = (
        F.when(slip, F.when(same_pref, "slip")).when(~agree, F.lit(None)).when((qa == qb) & (n == 3), "full")
        .when((qa == qb) & (n > 0), F.when(same_pref, "part")).when(wider, F.when(same_pref, "city"))
    )
    cities = (c(a, "city") != "") & (c(b, "city") != "")
    known = F.when(cities, F.when(c(a, "city") == c(b, "city"), inside)).otherwise(F.when(same_pref, "open"))
    return F.coalesce(known, F.lit("apart"))


def name_score(a: dict, b: dict) -> float:
    """Soft token similarity of two names, each token weighted by its rarity."""
    wa, wb = a["w"], b["w"]
    total = got = 0.0
    for k in ("snd", "area", "types", "corp", "brand", "han"):
        x, y = a[k], b[k]
        if not x or not y:
            continue
        if k == "han":  # spellings in kanji that sound alike are not quite the same
            if min(len(x), len(y)) >= 2:
                w = 0.15 * (wa.get("snd", 0.5) + wb.get("snd", 0.5))
                total += w
                got += w * len(set(x) & set(y)) / min(len(set(x)), len(set(y)))
            continue
        w = (wa.get(k, 0.5) + wb.get(k, 0.5)) / 2
        if k == "snd":
            longest = max(len(x), len(y))
            sim = 1 - min(osa(x, y, longest), longest) / longest
            if min(len(x), len(y)) >= 5 and (x.startswith(y) or y.startswith(x)):
                sim = max(sim, 0.8)
        elif k == "types":
            p, q = set(x.split("+")), set(y.split("+"))
            sim = len(p & q) / min(len(p), len(q))
            w *= 0.3
        else:
            sim = float(x == y)
            if k == "area" and not sim:
                w *= 2  # another side of the same quarter is another site
            if k in ("corp", "brand"):
                w *= 0.4
        total += w
        got += w * sim
    return got / total if total else 0.0


@F.pandas_udf(DoubleType())
def _score(a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
    out = []
    for x, y in zip(a.to_dict("records"), b.to_dict("records"), strict=True):
        x["w"], y["w"] = dict(x["w"]), dict(y["w"])
        out.append(name_score(x, y))
    return pd.Series(out, dtype="float64")


def sided(pairs: DataFrame, forms: DataFrame) -> DataFrame:
    """pairs (a, b, relation) with the name score and the keys of both forms, prefixed a_ and b_."""
    side = lambda s: forms.select(F.col("form").alias(s), *[F.col(k).alias(f"{s}_{k}") for k in (*KEYS, "w")])
    of = lambda s: F.struct(*[F.col(f"{s}_{k}").alias(k) for k in ("corp", "brand", "snd", "area", "types", "han", "w")])
    return joined(joined(pairs, side("a"), "a"), side("b"), "b").withColumn("score", _score(of("a"), of("b")))


def scored(pairs: DataFrame, forms: DataFrame) -> DataFrame:
    """pairs (a, b, relation) with the name score."""
    return sided(pairs, forms).select("a", "b", "score", "relation")


def candidates(left: DataFrame, right: DataFrame | None = None, contrast: bool = False) -> DataFrame:
    """Pairs (a, b, relation) of forms that can be one facility by their addresses and share a rare gram.

    With one table a < b; with two, a is of the left and b of the right. With contrast there are also pairs of one
    municipality whose addresses disagree ("apart") and that share one of the CONTRAST rarest grams of both, for a model to learn from.
    """
    one = right is None
    cols = ["form", "snd", *PLACES]
    tagged = lambda rows, l, r: rows.select(*cols, F.lit(l).alias("is_a"), F.lit(r).alias("is_b"))
    both = tagged(left, True, True)
    if not one:
        both = tagged(left, True, False).unionByName(tagged(right, False, True)).groupBy(*cols).agg(F.bool_or("is_a").alias("is_a"), F.bool_or("is_b").alias("is_b"))
    n = F.size("gs")
    near = F.slice("gs", F.lit(1), (n - F.ceil(n * NEAR) + 1).cast("int")).alias("near")
    base = cut(joined(both, ordered_grams(both), "form").select(*cols, "is_a", "is_b", near))
    x, y = base.where("is_a"), base.where("is_b")
    ways = ("a",) if one else ("a", "b")  # on which side the address is the poorer one
    placed, numbered, in_pref = F.col("city") != "", F.col("nums") != "", F.col("pref") != ""
    spread = max(1, y.count() // (CONTRAST * 47)) if contrast else 1  # buckets that leave each form about CONTRAST partners in its prefecture

    def keys(tag: str, kind: str, *of: Column, grams_: Column | str, where: Column | None = None) -> Column:
        """A key for each gram, of the records where the condition holds; all kinds of keys are met in one join."""
        k = F.transform(grams_, lambda g: F.struct(F.lit(tag).alias("tag"), F.xxhash64(F.lit(kind), *of, g).alias("k")))
        return k if where is None else F.when(where, k).otherwise(F.array().cast("array<struct<tag:string,k:bigint>>"))

    def near_tokens(rows: DataFrame, s: str) -> DataFrame:
        """A row for each key, columns prefixed; what the key already holds equal is not carried."""
        first = F.get(F.split("nums", "-"), F.lit(0))
        full = F.when(F.size(F.split("nums", "-")) == 3, F.array(F.concat(F.lit("#"), "nums"))).otherwise(F.array().cast("array<string>"))
        of = [keys("number", "number", F.col("city"), F.col("quarter"), first, grams_=F.concat("near", full), where=placed & numbered)]
        of += [keys("city", f"city {w}", F.col("city"), grams_="near", where=placed & ~numbered if s == w else placed) for w in ways]
        if contrast:
            of.append(keys("drawn", "drawn", F.col("pref"), F.pmod(F.xxhash64("form"), F.lit(spread)), grams_=F.array(F.lit(""))))
        tag, same = F.col("t.tag"), F.lit("=")
        quarter, city = F.when(tag == "number", same).otherwise(F.col("quarter")), F.when(tag == "drawn", F.col("city")).otherwise(same)
        rows = rows.select(F.explode(F.concat(*of)).alias("t"), "form", *PLACES)
        return rows.select("t.*", F.col("form").alias(s), F.col("pref").alias(f"{s}_pref"), city.alias(f"{s}_city"), quarter.alias(f"{s}_quarter"), F.col("nums").alias(f"{s}_nums"))

    def far_forms(rows: DataFrame, s: str) -> DataFrame:
        """(scope, probing, snd, form) within a known prefecture, and with an unknown one anywhere; the few names without a municipality look for the others."""
        of = []
        for w in ways:
            if s == w:
                few = (~placed & in_pref, ~placed & ~in_pref, ~placed & in_pref)
            else:
                few = (in_pref, None, ~in_pref)
            for (kind, *at), c in zip((("pref", F.col("pref")), ("any",), ("rest",)), few, strict=True):
                one_of = F.struct(F.xxhash64(F.lit(f"{kind} {w}"), *at).alias("scope"), F.lit(s == w).alias("probing"))
                of.append(one_of if c is None else F.when(c, one_of))
        return rows.select(F.explode(F.array_compact(F.array(*of))).alias("t"), "snd", F.col("form").alias(s)).select("t.*", "snd", F.xxhash64("t.scope", "snd").alias(f"{s}_far"), s)

    def far_tokens(forms_: DataFrame, s: str) -> DataFrame:
        """A row for each key of each sound of a scope; its forms come in when the sounds have met."""
        sounds = forms_.select("scope", "probing", "snd", f"{s}_far").distinct().withColumn("of", far_keys("snd", "probing"))
        return sounds.select(F.explode("of.keys").alias("key"), "scope", f"{s}_far", F.col("snd").alias(f"{s}_snd"), F.col("of.bits").alias(f"{s}_bits")).select(
            F.xxhash64("scope", "key").alias("k"), f"{s}_far", f"{s}_snd", f"{s}_bits"
        )

    p = joined(near_tokens(x, "a"), near_tokens(y, "b").drop("tag"), "k")
    p = p.where(F.when(F.col("tag") == "number", F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b")) if one else F.col("a") != F.col("b"))
    texts = lambda *of: F.array(*map(F.lit, of))
    kinds = F.when(F.col("tag") == "number", texts(*FIRM)).when(F.col("tag") == "city", texts("city")).otherwise(texts(*LEAST, "apart"))
    near_pairs = p.withColumn("relation", relation("a", "b")).where(F.array_contains(kinds, F.col("relation"))).select("a", "b", "relation")
    # alike enough for open addresses; the key sees to the prefecture
    fx, fy = far_forms(x, "a"), far_forms(y, "b")
    p = joined(far_tokens(fx, "a"), far_tokens(fy, "b"), "k")
    la, lb = F.length("a_snd"), F.length("b_snd")
    most = edits(F.least(la, lb))
    can = (F.abs(la - lb) <= FAR) & (F.bit_count(F.col("a_bits").bitwiseXOR(F.col("b_bits"))) <= 4 * most)
    alike = cut(p.where(can & F.levenshtein("a_snd", "b_snd", 4).between(0, most)).select("a_far", "b_far").distinct())
    some = cut(joined(alike, fx.select("a_far", "a"), "a_far").select("a", "b_far"))
    p = joined(some, fy.select("b_far", "b"), "b_far").where("a != b")
    out = near_pairs.unionByName(p.select("a", "b", F.lit("open").alias("relation")))
    if one:
        out = out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "relation")
    return out.distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each connected group; rounds of hooking and pointer jumping until nothing changes."""
    both = cut(edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(edges.select(F.col("b").alias("x"), F.col("a").alias("y"))))
    roots = nodes.select(F.col("node"), F.col("node").alias("root"))
    while True:
        seen = joined(both, roots.select(F.col("node").alias("y"), F.col("root").alias("r")), "y").groupBy("x").agg(F.min("r").alias("r"))
        hooked = joined(roots, seen.withColumnRenamed("x", "node"), "node", "left").select("node", F.col("root").alias("old"), F.least("root", F.coalesce("r", "root")).alias("root"))
        jump = hooked.select(F.col("node").alias("root"), F.col("root").alias("next"))
        new = cut(joined(hooked, jump, "root", "left").select("node", "old", F.coalesce("next", "root").alias("root")))
        changed = new.where("root != old").limit(1).count()
        roots = new.select("node", "root")
        if not changed:
            return roots


def passes(rel: Column, score: Column) -> Column:
    out = F.lit(False)
    for r in FIRM:
        out = out | ((rel == r) & (score >= LEAST[r]))
    return out


def leads(score: str, following: str) -> Column:
    """Whether the best of several groups is clearly the best."""
    gap = F.col(score) - F.col(following)
    return F.col(following).isNull() | (gap > STANDS_OUT) | ((F.col(score) >= EXACT) & (gap > CLOSER))


def groups(recs: DataFrame) -> DataFrame:
    """(rec, root) of all records with a name; root is the same for records that mean one facility."""
    recs = cut(keyed(recs))
    return grouped(recs, cut(forms_of(recs))).select("rec", "root")


def grouped(recs: DataFrame, forms: DataFrame) -> DataFrame:
    """(rec, form, root) of keyed records and their forms."""
    own = recs.where("snd != ''").select("rec", F.xxhash64(*KEYS).alias("form"))
    links = cut(scored(candidates(forms), forms))
    return joined(own, rooted(forms, links), "form").select("rec", "form", "root")


def rooted(forms: DataFrame, links: DataFrame) -> DataFrame:
    """(form, root): links closed to groups, and forms without a house number attached to the one group that fits."""
    firm = links.where(passes(F.col("relation"), F.col("score"))).select("a", "b")
    roots = components(forms.select(F.col("form").alias("node")), firm)
    # forms without a house number: to the one group that fits, the best by score if it stands out
    open_ = links.where(
        ((F.col("relation") == "open") & (F.col("score") >= LEAST["open"])) | ((F.col("relation") == "city") & (F.col("score") >= LEAST["city"]))
    )
    placed = forms.select(F.col("form").alias("f"), (F.col("nums") != "").alias("placed"))
    ends = open_.select(F.col("a").alias("f"), F.col("b").alias("g"), "score").unionByName(open_.select(F.col("b").alias("f"), F.col("a").alias("g"), "score"))
    ends = joined(joined(ends, placed.where("not placed").select("f"), "f"), placed.where("placed").select(F.col("f").alias("g")), "g")
    # a group's prefecture is known from any of its forms
    homes = joined(roots, forms.select(F.col("form").alias("node"), "pref"), "node").groupBy(F.col("root").alias("gr")).agg(F.max("pref").alias("home"))
    ends = joined(joined(ends, roots.select(F.col("node").alias("g"), F.col("root").alias("gr")), "g"), homes, "gr")
    ends = joined(ends, forms.select(F.col("form").alias("f"), "pref"), "f").where("pref = '' or home = '' or pref = home")
    ends = ends.groupBy("f", "gr").agg(F.max("score").alias("score"), F.min("g").alias("g"))
    rank = Window.partitionBy("f").orderBy(F.desc("score"), "gr")
    ends = ends.withColumn("n", F.row_number().over(rank)).withColumn("next", F.lead("score").over(rank))
    single = cut(ends.where((F.col("n") == 1) & leads("score", "next")).select(F.col("f").alias("a"), F.col("g").alias("b")))
    # and to each other where neither has a number and the names are as good as equal, or alike in one municipality
    alike = ((F.col("relation") == "open") & (F.col("score") >= 0.97)) | ((F.col("relation") == "city") & (F.col("score") >= 0.85))
    bare = placed.where("not placed").select("f")
    loose = joined(joined(open_.where(alike), bare.withColumnRenamed("f", "a"), "a"), bare.withColumnRenamed("f", "b"), "b").select("a", "b")
    fitted = single.select(F.col("a").alias("f")).distinct()
    loose = joined(joined(loose, fitted.withColumnRenamed("f", "a"), "a", "left_anti"), fitted.withColumnRenamed("f", "b"), "b", "left_anti")
    # the second closure joins the groups of the first
    of = lambda s: roots.select(F.col("node").alias(s), F.col("root").alias(f"r{s}"))
    more = joined(joined(single.unionByName(loose), of("a"), "a"), of("b"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).where("a != b").distinct()
    more = cut(more)
    nodes = more.select(F.col("a").alias("node")).union(more.select("b")).distinct()
    tops = components(nodes, more).select(F.col("node").alias("root"), F.col("root").alias("_top"))
    return joined(roots, tops, "root", "left").select(F.col("node").alias("form"), F.coalesce("_top", "root").alias("root"))


def linked(recs: DataFrame) -> DataFrame:
    """(rec, root, links): each record with a name, its group and the number of other records in it."""
    g = cut(groups(recs))
    return joined(g, g.groupBy("root").agg((F.count("*") - 1).alias("links")), "root").select("rec", "root", "links")


def same_facility(recs: DataFrame) -> DataFrame:
    """(rec_a, rec_b): all pairs of each group, rec_a < rec_b; linked() gives the groups without writing out their pairs."""
    g = cut(groups(recs))
    x, y = g.select(F.col("rec").alias("rec_a"), "root"), g.select(F.col("rec").alias("rec_b"), "root")
    return joined(x, y, "root").where("rec_a < rec_b").select("rec_a", "rec_b")
