"""Queries on names, joins, evidence and overrides over whole tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.functions import text as T
from reconlake.operators import aggregate as A
from reconlake.operators import linkage as L
from reconlake.operators import ordering as O
from reconlake.operators import overrides as U
from reconlake.operators import reconcile as R
from reconlake.plans import sqltext as Q
from reconlake.plans.register import collector
from reconlake.session import load

QUERIES, ORACLES, query = collector()

# ---------------------------------------------------------------- text forms


@query(f"""SELECT plan_id, {Q.compact('n', T.KEY_SIGNS)} AS key_form, {Q.compact('n', T.KEY_SIGNS_MARKS)} AS key_form_marks, {Q.compact('n', T.LIST_SIGNS)} AS list_form, trim(n) AS plain_form,
lower(replace(regexp_replace(treatment, '[\\s　・･]', '', 'g'), '，', ',')) AS no_separators FROM (SELECT plan_id, treatment, {Q.nfkc('treatment')} AS n FROM treatment_plan)""")
def normal_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("treatment")
    return load(spark, sf_dir, "treatment_plan").select(
        "plan_id", T.compact(t, T.KEY_SIGNS).alias("key_form"), T.compact(t, T.KEY_SIGNS_MARKS).alias("key_form_marks"), T.compact(t, T.LIST_SIGNS).alias("list_form"),
        T.plain_form(t).alias("plain_form"), T.no_separators(t).alias("no_separators"),
    )


@query(f"""SELECT row_id, {Q.nfkc('facility')} AS facility FROM price_stage WHERE facility <> {Q.nfkc('facility')}""")
def facilities_in_other_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facility names that are not in compatibility form, in that form; letters made of several signs are left to the normaliser."""
    p = load(spark, sf_dir, "price_stage").select("row_id", F.col("facility").alias("typed"), T.nfkc(F.col("facility")).alias("facility"))
    return p.where(F.col("typed") != F.col("facility")).select("row_id", "facility")


_SPLIT = "list_distinct(list_filter(list_transform(regexp_split_to_array({c}, '[|/]'), lambda x: trim(x)), lambda x: x <> '' AND x NOT IN ('未確認', '不明', 'UNKNOWN')))"


@query(f"""SELECT row_id, array_to_string(list_sort({_SPLIT.format(c='makers')}), ';') AS makers FROM price_stage WHERE makers IS NOT NULL""")
def makers_as_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "price_stage").where("makers is not null")
    return p.select("row_id", F.array_join(F.array_sort(T.split_set(F.col("makers"))), ";").alias("makers"))


@query(f"""WITH a AS (SELECT lower(trim(regexp_replace({Q.nfkc('product')}, '[\\s　]+', ' ', 'g'))) AS s, {Q.compact(Q.nfkc('product'), T.LIST_SIGNS)} AS t, canonical_product AS c FROM product_registry),
s AS (SELECT s, min(c) AS c FROM a GROUP BY s), t AS (SELECT t, min(c) AS c FROM a GROUP BY t),
v AS (SELECT locator_id, trim(n) AS plain, lower(trim(regexp_replace(n, '[\\s　]+', ' ', 'g'))) AS s, {Q.compact('n', T.LIST_SIGNS)} AS t FROM (SELECT locator_id, {Q.nfkc('products')} AS n FROM locator))
SELECT locator_id, coalesce(s.c, t.c, plain) AS canonical FROM v LEFT JOIN s USING (s) LEFT JOIN t USING (t)""")
def canonical_by_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of the clinic finders by two-stage alias lookup; unknown ones stay as they are."""
    v = T.by_alias(load(spark, sf_dir, "locator").select("locator_id", "products"), "products", load(spark, sf_dir, "product_registry"), "product", "canonical_product")
    return v.select("locator_id", "canonical")


@query("""SELECT facility_id, concat_ws(' ', CASE WHEN contains(facility, ' ') THEN '"' || facility || '"' ELSE facility END, nullif(prefecture, ''), '費用') AS query FROM nonqueue_facility""")
def search_query_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = T.query_string(F.col("facility"), F.col("prefecture"), F.lit("費用"))
    return load(spark, sf_dir, "nonqueue_facility").select("facility_id", q.alias("query"))


@query("""WITH m AS (SELECT map(list(product), list(canonical_product)) AS m FROM product_registry), g AS (SELECT map(list(c), list(f)) AS g FROM (SELECT canonical_product AS c, min(manufacturer_share_group) AS f FROM product_registry GROUP BY 1)),
v AS (SELECT row_id, list_transform(list_filter(list_transform(regexp_split_to_array(products, '[|/]'), lambda x: trim(x)), lambda x: x <> ''), lambda x: coalesce(m[x], x)) AS v FROM price_stage, m WHERE products IS NOT NULL),
p AS (SELECT row_id, list_filter(v, lambda x, i: list_position(v, x) = i) AS p FROM v), k AS (SELECT row_id, p, list_filter(list_transform(p, lambda x: g[x]), lambda x: x IS NOT NULL) AS k FROM p, g)
SELECT row_id, array_to_string(p, '|') AS products, array_to_string(list_filter(k, lambda x, i: list_position(k, x) = i), '|') AS makers FROM k""")
def products_with_makers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of a field in their canonical form, each once and in order, and their makers derived from them."""
    registry = load(spark, sf_dir, "product_registry")
    entries = registry.select("product", "canonical_product", "manufacturer_share_group").limit(10_001).collect()
    if len(entries) > 10_000:
        raise ValueError("the list has more than 10000 entries; use a join")
    maker: dict[str, str] = {}
    for r in entries:
        maker[r[1]] = min(maker.get(r[1], r[2]), r[2])
    of = lambda d: F.map_from_arrays(F.array(*[F.lit(k) for k in d]), F.array(*[F.lit(v) for v in d.values()]))
    parts = F.filter(F.transform(F.split("products", "[|/]"), lambda p: F.trim(p)), lambda p: p != "")
    p = load(spark, sf_dir, "price_stage").where("products is not null").select("row_id", T.canonical_unique(parts, of({r[0]: r[1] for r in entries})).alias("p"))
    makers = F.array_distinct(F.array_compact(F.transform("p", lambda x: F.element_at(of(maker), x))))
    return p.select("row_id", F.array_join("p", "|").alias("products"), F.array_join(makers, "|").alias("makers"))


# ---------------------------------------------------------------- joins

_STEM = Q.strip_legal(Q.compact("n"))
_PLACED = f"""l AS (SELECT facility_id, {_STEM} AS name, {Q.address_key('a', 'prefecture')} AS address, prefecture AS place FROM (SELECT facility_id, prefecture, {Q.nfkc('facility')} AS n, {Q.nfkc('address')} AS a FROM nonqueue_facility)),
r AS (SELECT locator_id, {_STEM} AS name, {Q.address_key('a', 'place')} AS address, place FROM (SELECT locator_id, {Q.prefecture('address')} AS place, {Q.nfkc('name')} AS n, {Q.nfkc('address')} AS a FROM locator))"""


def _placed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Facilities and finder entries with name and address keys and the prefecture they state."""
    f, r = load(spark, sf_dir, "nonqueue_facility"), load(spark, sf_dir, "locator").withColumn("place", T.prefecture_of(F.col("address")))
    name = lambda c: T.strip_legal(T.compact(F.col(c))).alias("name")
    left = f.select("facility_id", name("facility"), T.address_key(F.col("address"), F.col("prefecture")).alias("address"), F.col("prefecture").alias("place"))
    return left, r.select("locator_id", name("name"), T.address_key(F.col("address"), F.col("place")).alias("address"), "place")


@query(f"""WITH {_PLACED}, m AS (SELECT facility_id, locator_id,
CASE WHEN l.name = r.name AND l.name <> '' THEN 100 WHEN least(length(l.name), length(r.name)) >= 5 AND (contains(l.name, r.name) OR contains(r.name, l.name)) THEN 92 ELSE 0 END AS n,
CASE WHEN l.address = r.address AND l.address <> '' THEN 100 WHEN least(length(l.address), length(r.address)) >= 8 AND (contains(l.address, r.address) OR contains(r.address, l.address)) THEN 96 ELSE 0 END AS a
FROM l JOIN r USING (place))
SELECT facility_id, locator_id, CAST(coalesce(n, 0) AS BIGINT) AS name_score, CAST(coalesce(a, 0) AS BIGINT) AS address_score, CAST(greatest(coalesce(n, 0), coalesce(a, 0)) AS BIGINT) AS score FROM m WHERE greatest(coalesce(n, 0), coalesce(a, 0)) >= 92""")
def name_or_address_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _placed(spark, sf_dir)
    return L.matches_by_name_or_address(left, right, "facility_id", "locator_id", "name", "address", "place")


@query(f"""WITH {_PLACED}, m AS (SELECT l.facility_id, array_to_string(list_sort(list_distinct(list(k.source))), '|') AS makers
FROM l JOIN (SELECT r.*, source FROM r JOIN locator USING (locator_id)) k ON l.place = k.place AND (l.name = k.name OR least(length(l.name), length(k.name)) >= 6 AND (contains(l.name, k.name) OR contains(k.name, l.name))) WHERE source IS NOT NULL GROUP BY 1)
SELECT facility_id, coalesce(makers, '') AS makers FROM l LEFT JOIN m USING (facility_id)""")
def makers_by_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The makers whose finder has a name of the same prefecture that is a facility's, or lies inside or around it."""
    left, right = _placed(spark, sf_dir)
    known = right.join(load(spark, sf_dir, "locator").select("locator_id", "source"), "locator_id").where("source is not null")
    known = known.groupBy("name", "place").agg(F.collect_set("source").alias("makers"))
    out = L.enriched_by_alias(left.withColumn("makers", F.array().cast("array<string>")), known, "facility_id", "name", "place", "makers")
    return out.select("facility_id", F.array_join("makers", "|").alias("makers"))


@query(f"""WITH l AS (SELECT locator_id, {Q.compact('n')} AS name, {Q.digits_key('a')} AS address FROM (SELECT locator_id, {Q.nfkc('name')} AS n, {Q.nfkc('address')} AS a FROM locator)),
f AS (SELECT {Q.compact('n')} AS name, {Q.digits_key('a')} AS address FROM (SELECT {Q.nfkc('facility')} AS n, {Q.nfkc('address')} AS a FROM nonqueue_facility))
SELECT locator_id, coalesce(name IN (SELECT name FROM f WHERE name IS NOT NULL), false) AS known_name, coalesce(address IN (SELECT address FROM f WHERE address IS NOT NULL), false) AS known_address,
locator_id IN (SELECT 'L' || lpad(CAST(match_id AS VARCHAR), 8, '0') FROM locator_match WHERE already_manual_verified = 'YES') AS verified FROM l""")
def existence_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the name and the address of a finder entry are known, and whether it is among those verified by hand."""
    key = lambda n, a: (T.compact(F.col(n)).alias("name"), T.address_digits_key(F.col(a)).alias("address"))
    r = load(spark, sf_dir, "locator").select("locator_id", *key("name", "address"))
    f = load(spark, sf_dir, "nonqueue_facility").select(*key("facility", "address"))
    done = load(spark, sf_dir, "locator_match").where("already_manual_verified = 'YES'")
    done = done.select(F.concat(F.lit("L"), F.lpad(F.col("match_id").cast("string"), 8, "0")).alias("locator_id"))
    out = L.flagged(r, ["name"], {"known_name": f})
    out = L.flagged(out, ["address"], {"known_address": f})
    return L.flagged(out, ["locator_id"], {"verified": done}).select("locator_id", "known_name", "known_address", "verified")


@query()
def same_address_best_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the facilities at the address of a finder entry the one with the most similar name; by Ratcliff-Obershelp, which SQL lacks."""
    key = lambda n, a: (T.compact(F.col(n), T.KEY_SIGNS_MARKS).alias("name"), T.address_digits_key(F.col(a)).alias("address"))
    r = load(spark, sf_dir, "locator").select("locator_id", *key("name", "address"))
    f = load(spark, sf_dir, "nonqueue_facility").select("facility_id", *key("facility", "address"))
    return L.best_at_address(r, f, "locator_id", "facility_id", "address", "name")


@query()
def best_by_facility_and_treatment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each plan's best match by facility and treatment among all other plans of its class and prefecture; by Ratcliff-Obershelp.

    As in the lists these come from, a class that is not the second counts as the third. Plans without a facility name or
    without a treatment match nothing; one without a prefecture meets all.
    """
    t = load(spark, sf_dir, "treatment_plan")
    keyed = t.select(
        "plan_id", F.when(F.contains("category", F.lit("第二")), "2").otherwise("3").alias("kind"), F.when(F.col("prefecture") != "", F.col("prefecture")).alias("place"),
        T.compact(F.col("facility"), T.KEY_SIGNS_MARKS).alias("name"), T.compact(F.col("treatment"), T.KEY_SIGNS_MARKS).alias("what"),
    ).where("plan_id is not null and name <> '' and what <> ''")
    return L.best_by_two_names(keyed, keyed.withColumnRenamed("plan_id", "other_id"), "plan_id", "other_id", least_name=0.0, others=True)


# ---------------------------------------------------------------- evidence and counts


@query("""WITH u AS (SELECT facility_id, makers AS maker, 'price' AS tag FROM price_stage WHERE makers <> '' UNION SELECT facility_id, treatment_class, 'plan' FROM treatment_plan WHERE treatment_class <> '' UNION SELECT facility_id, treatment_class, 'price class' FROM price_stage WHERE treatment_class <> '')
SELECT facility_id, maker, array_to_string(list_sort(list_distinct(list(tag))), '|') AS tags FROM u GROUP BY facility_id, maker""")
def evidence_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, t = load(spark, sf_dir, "price_stage"), load(spark, sf_dir, "treatment_plan")
    of = lambda df, c: df.select("facility_id", F.col(c).alias("maker"))
    return A.tagged_union({"price": of(p, "makers"), "plan": of(t, "treatment_class"), "price class": of(p, "treatment_class")}, ["facility_id"], "maker")


@query("""SELECT facility_id, coalesce(array_to_string(list_sort(list_distinct(list(mhlw_plan_code))), '|'), '') AS codes, coalesce(array_to_string(list_sort(list_distinct(list(treatment_class) FILTER (treatment_class <> ''))), '|'), '') AS classes,
arg_min(facility, plan_id) FILTER (facility <> '') AS facility, arg_min(address, plan_id) FILTER (address <> '') AS address FROM treatment_plan GROUP BY facility_id HAVING count(DISTINCT mhlw_plan_code) > 1""")
def facility_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities with several plans: their codes and classes, and the first name and address stated."""
    t = load(spark, sf_dir, "treatment_plan")
    sets = A.evidence_union(t, ["facility_id"], {"codes": "mhlw_plan_code", "classes": "treatment_class"}, {}, "plan_id")
    first = A.first_nonempty(t, ["facility_id"], ["facility", "address"], "plan_id")
    many = t.groupBy("facility_id").agg(F.countDistinct("mhlw_plan_code").alias("_n")).where("_n > 1").select("facility_id")
    return many.join(sets, "facility_id").join(first, "facility_id")


@query("""WITH p AS (SELECT facility_id, count(DISTINCT makers) AS n FROM price_stage GROUP BY facility_id)
SELECT CAST(count_if(n > 0) AS BIGINT) AS known, round(100.0 * count_if(n > 0) / 949, 2) AS known_pct, CAST(sum(n) AS BIGINT) AS placements, CAST(count_if(n > 1) AS BIGINT) AS multiple FROM p""")
def placement_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities with a known maker against a fixed number of facilities."""
    return A.placement_summary(load(spark, sf_dir, "price_stage"), "facility_id", "makers", 949)


@query("""SELECT value, CAST(n AS BIGINT) AS n, CAST(row_number() OVER (ORDER BY n DESC, o, i, value) AS BIGINT) AS place FROM (SELECT value, count(*) AS n, min((row_id, i)).row_id AS o, min((row_id, i)).i AS i
FROM (SELECT row_id, unnest(v) AS value, unnest(generate_series(1, len(v))) AS i FROM (SELECT row_id, list_filter(list_transform(regexp_split_to_array(makers, '[|/]'), lambda x: trim(x)), lambda x: x <> '') AS v FROM price_stage)) GROUP BY value)""".replace("min((row_id, i)).row_id AS o, min((row_id, i)).i AS i", "min(row_id * 1000 + i) AS o, 0 AS i"))
def most_common_makers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Makers by number of mentions; of equally frequent ones the first seen comes first."""
    v = F.filter(F.transform(F.split("makers", "[|/]"), lambda p: F.trim(p)), lambda p: p != "")
    return A.most_common(load(spark, sf_dir, "price_stage").select("row_id", v.alias("v")), "v", "row_id")


@query("""SELECT plan_id, len(list_filter(l, lambda x: x.label = '料金表')) = len(l) AS all_prices, len(list_filter(l, lambda x: x.label = '料金表')) > 0 AS any_prices, len(list_filter(l, lambda x: x.label = '料金表')) = 0 AS no_prices
FROM (SELECT plan_id, document_urls_source AS l FROM treatment_plan WHERE document_urls_source IS NOT NULL)""")
def link_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether all, any or none of a plan's documents are price lists."""
    t = load(spark, sf_dir, "treatment_plan").where("document_urls_source is not null")
    s = t.select("plan_id", A.array_tests(F.col("document_urls_source"), lambda x: x["label"] == "料金表").alias("t"))
    return s.select("plan_id", F.col("t.all").alias("all_prices"), F.col("t.any").alias("any_prices"), F.col("t.none").alias("no_prices"))


# ---------------------------------------------------------------- order, partitions, overrides


@query("""SELECT row_id, plan_id, CAST(q AS BIGINT) AS ordinal FROM price_stage LEFT JOIN (SELECT plan_id, min(queue_index) AS q FROM price_stage WHERE lane = 'A' GROUP BY plan_id) USING (plan_id)""")
def in_queue_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the place of their plan in the queue of lane A, in its order."""
    p = load(spark, sf_dir, "price_stage")
    queue = p.where("lane = 'A'").select("plan_id", F.col("queue_index").alias("ordinal"))
    return O.in_order_of(p.select("row_id", "plan_id"), queue, "plan_id", "ordinal").select("row_id", "plan_id", "ordinal")


@query("""WITH e AS (SELECT *, row_number() OVER w - 1 AS i, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS m FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(m) OVER (PARTITION BY user_id ORDER BY i ROWS 1 PRECEDING) AS run FROM e),
s AS (SELECT *, coalesce(max(CASE WHEN run = 2 AND i >= 2 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped FROM r)
SELECT event_id, user_id FROM s WHERE stopped = 0""")
def until_two_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events up to the second error in a row, the third event at the earliest."""
    e = load(spark, sf_dir, "events").withColumn("_o", F.struct("ts", "event_id"))
    return O.until_misses(e, "user_id", "_o", F.col("event_type") == "error").select("event_id", "user_id")


@query("""WITH t AS (SELECT DISTINCT plan_id, lane FROM price_stage), n AS (SELECT plan_id, count(DISTINCT lane) AS k FROM t GROUP BY plan_id), w AS (SELECT DISTINCT plan_id FROM treatment_plan)
SELECT CAST((SELECT count(DISTINCT lane) FROM t) AS BIGINT) AS parts, CAST(count_if(k > 1) AS BIGINT) AS overlapping, CAST(count(n.plan_id) AS BIGINT) AS covered, CAST(count(w.plan_id) AS BIGINT) AS total,
CAST(count_if(n.plan_id IS NULL) AS BIGINT) AS missing, CAST(count_if(w.plan_id IS NULL) AS BIGINT) AS beyond, count_if(k > 1) = 0 AND count_if(n.plan_id IS NULL) = 0 AND count_if(w.plan_id IS NULL) = 0 AS is_partition FROM n FULL JOIN w ON n.plan_id = w.plan_id""")
def lanes_as_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the lanes divide the plans between them without overlap or gap."""
    return R.partition_proof(load(spark, sf_dir, "price_stage").select("plan_id", "lane"), "plan_id", "lane", load(spark, sf_dir, "treatment_plan"))


@query("""SELECT CAST(count(*) AS BIGINT) AS total, CAST(count_if(plan_id IN (SELECT plan_id FROM price_stage WHERE status = 'FAIL')) AS BIGINT) AS excluded, CAST(count_if(plan_id NOT IN (SELECT plan_id FROM price_stage WHERE status = 'FAIL')) AS BIGINT) AS remaining FROM (SELECT DISTINCT plan_id FROM treatment_plan)""")
def reduced_plan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.reduced_count(load(spark, sf_dir, "treatment_plan"), load(spark, sf_dir, "price_stage").where("status = 'FAIL'"), "plan_id")


@query("""WITH d AS (SELECT o_orderkey, max(l_quantity) >= 45 AS ok FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT o_orderkey, CASE WHEN ok THEN 'promoted' WHEN NOT ok THEN 'reviewed' ELSE o_orderstatus END AS status FROM orders LEFT JOIN d USING (o_orderkey)""")
def settled_by_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a decision take its outcome, the others keep their state."""
    o, l = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status")), load(spark, sf_dir, "lineitem")
    d = o.where("status = 'F'").join(l, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderkey").agg((F.max("l_quantity") >= 45).alias("ok"))
    return U.settled(o, d, "o_orderkey", "status", "ok", F.lit("promoted"), F.lit("reviewed"))


@query("""WITH b AS (SELECT l_orderkey AS k, list(l_quantity ORDER BY l_linenumber) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), o AS (SELECT l_orderkey AS k, list(l_quantity ORDER BY l_linenumber) AS q FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
SELECT k, CAST(len(q) AS BIGINT) AS n FROM o UNION ALL SELECT k, CAST(len(list_distinct(q)) AS BIGINT) FROM b WHERE k NOT IN (SELECT k FROM o) AND len(q) <= 3 AND len(list_filter(q, lambda x: x < 40)) = len(q)""")
def lists_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of new keys come in only if they are short and all their entries usable."""
    l = load(spark, sf_dir, "lineitem")
    of = lambda f: l.where(F.col("l_returnflag") == f).groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list("l_quantity").alias("q"))
    return U.insert_lists_if_absent(of("A"), of("R"), "k", "q", lambda x: x < 40, 3).select("k", F.size("q").cast("bigint").alias("n"))


@query("""SELECT row_id, CASE WHEN amount IS NULL THEN 'FAIL' WHEN tax IS NULL THEN 'QC' ELSE 'AUTO' END AS status, status IS DISTINCT FROM (CASE WHEN amount IS NULL THEN 'FAIL' WHEN tax IS NULL THEN 'QC' ELSE 'AUTO' END) AS changed FROM price_stage""")
def reclassified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.when(F.col("amount").isNull(), "FAIL").when(F.col("tax").isNull(), "QC").otherwise("AUTO")
    return U.reclassified(load(spark, sf_dir, "price_stage"), "status", now).select("row_id", "status", "changed")


@query("""WITH a AS (SELECT facility_id, list_sort(list_distinct(list(treatment_class))) AS l FROM treatment_plan WHERE treatment_class IS NOT NULL GROUP BY 1), b AS (SELECT facility_id, list_sort(list_distinct(list(treatment_class))) AS r FROM price_stage WHERE treatment_class IS NOT NULL GROUP BY 1)
SELECT facility_id, array_to_string(l, '|') AS plan_says, array_to_string(r, '|') AS price_says, CASE WHEN r IS NULL THEN 'left only' WHEN l IS NULL THEN 'right only' WHEN l = r THEN 'same' ELSE 'conflict' END AS status FROM a FULL JOIN b USING (facility_id)""")
def both_sides_of_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What plans and prices say of a facility's treatment classes; neither overwrites the other."""
    b = U.both_sides(load(spark, sf_dir, "treatment_plan"), load(spark, sf_dir, "price_stage"), "facility_id", "treatment_class")
    return b.select("facility_id", F.array_join("left_values", "|").alias("plan_says"), F.array_join("right_values", "|").alias("price_says"), "status")


@query("""WITH new AS (SELECT s_suppkey, s_name || '*' AS s_name FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT s_suppkey + 1000000, s_name FROM supplier WHERE s_suppkey % 30 = 0), old AS (SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_name, s_suppkey) AS place FROM supplier)
SELECT s_suppkey, coalesce(new.s_name, old.s_name) AS s_name, CAST(place AS BIGINT) AS place FROM old FULL JOIN new USING (s_suppkey)""")
def upsert_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed rows replace the old ones at their place in the queue; new ones have none."""
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    new = s.where("s_suppkey % 3 = 0").withColumn("s_name", F.concat("s_name", F.lit("*"))).unionByName(s.where("s_suppkey % 30 = 0").withColumn("s_suppkey", F.col("s_suppkey") + 1000000))
    return U.upsert_in_order(O.numbered(s, ["s_name", "s_suppkey"], "place"), new.withColumn("place", F.lit(None).cast("bigint")), "s_suppkey", "place")


def lane_view(prices: DataFrame, lane: str, total: int) -> DataFrame:
    """One row: a lane's number of plans, those done, those pending of the stated total, and its latest check."""
    done = F.countDistinct("plan_id")
    return prices.where(F.col("lane") == lane).agg(F.lit(lane).alias("lane"), done.alias("done"), (F.lit(total) - done).alias("pending"), F.max("row_id").alias("latest"))


@query(" UNION ALL ".join(f"SELECT '{x}' AS lane, CAST(count(DISTINCT plan_id) AS BIGINT) AS done, CAST({n} - count(DISTINCT plan_id) AS BIGINT) AS pending, max(row_id) AS latest FROM price_stage WHERE lane = '{x}'" for x, n in (("A", 216), ("B", 335), ("C", 105))))
def lane_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view of each lane against its fixed total."""
    p = load(spark, sf_dir, "price_stage")
    a, b, c = (lane_view(p, x, n) for x, n in (("A", 216), ("B", 335), ("C", 105)))
    return a.unionByName(b).unionByName(c)
