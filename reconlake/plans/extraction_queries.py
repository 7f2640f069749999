"""Queries that take prices, labels and products out of texts, each with the SQL that gives the same rows where SQL has places in texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.functions import text as T
from reconlake.operators import aggregate as A
from reconlake.operators import extract as X
from reconlake.operators import linkage as L
from reconlake.plans import sqltext as Q
from reconlake.plans.register import collector
from reconlake.session import load

QUERIES, ORACLES, query = collector()

# --- fixed values: words that speak for a price of a treatment, on its line or near it, and against one ---
PRICE_WORDS = "治療費|施術料|治療料金|料金|費用|価格|自己負担|自由診療|自費"
TREATMENT_WORDS = "PRP|APS|ACP|GPS|幹細胞|再生医療|血小板|投与|注入|関節|腱|靭帯|筋|脂肪"
COURSE_WORDS = "1回|一回|1部位|一部位|片側|両側|回分|コース|クール|投与"
TAX_WORDS = "税込|税別|税抜|消費税"
ANCILLARY_WORDS = "初診|再診|診察料|検査料|感染症検査|血液検査|採血料|キャンセル|返金|文書料|証明書|送料|保管料|再処理|研究費|補償|賠償"
CONTACT_WORDS = "お問い合わせ|問合せ|要相談|連絡してください"
INSIDE_WORDS, OUTSIDE_WORDS = "関節内|関節腔|変形性関節|慢性関節|膝関節|股関節|軟骨|半月板", "関節外|靭帯|靱帯|筋腱|筋肉|筋膜|アキレス|腱板|肉離れ"
COMPETING = {"PRP": "脂肪由来|幹細胞|培養", "脂肪由来幹細胞": "多血小板|血小板", "骨髄濃縮": "多血小板|脂肪由来"}

RULES = [(PRICE_WORDS, 7, 3), (TREATMENT_WORDS, 5, 2), (COURSE_WORDS, 2, 1), (TAX_WORDS, 2, 1)]



_SCORE = " + ".join(f"CASE WHEN regexp_matches(line, '{p}') THEN {a} WHEN regexp_matches(near, '{p}') THEN {b} ELSE 0 END" for p, a, b in RULES)
_FLAT_LINES = """lines AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS line_no, line FROM (SELECT doc_id, unnest(generate_series(1, len(ls))) AS p, trim(unnest(ls), ' ') AS line
FROM (SELECT doc_id, string_split(regexp_replace(text, '[ \\t\\f　\\x{a0}]+', ' ', 'g'), chr(10)) AS ls FROM documents)) WHERE line <> ''),
near AS (SELECT doc_id, line_no, line, string_agg(line, ' ') OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near FROM lines)"""


def _product_list(spark: SparkSession, sf_dir: str) -> list[str]:
    rows = load(spark, sf_dir, "product_registry").select("product_id", "product").orderBy("product_id").limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("the list has more than 10000 names")
    return [r[1] for r in rows]


def _hits(k: int, pattern: str, times: int) -> str:
    """Amounts of a line; a blank after each sign lets the next amount follow at once."""
    bare = pattern.replace("(?<![0-9])", "(?:^|[^0-9])")
    all_ = f"regexp_extract_all(replace(line, '円', '円 '), '{bare}', 1)"
    return f"SELECT doc_id, line_no, line, near, {k} AS k, unnest(generate_series(1, len({all_}))) AS h, CAST(floor(CAST(replace(unnest({all_}), ',', '') AS DOUBLE) * {times}) AS BIGINT) AS amount FROM near"


_PRICES = f"""WITH {_FLAT_LINES}, n AS (SELECT list(product ORDER BY product_id) AS names FROM product_registry),
h AS ({_hits(0, X.YEN_AMOUNT, 1)} UNION ALL {_hits(1, X.TEN_THOUSAND_AMOUNT, 10000)}),
f AS (SELECT doc_id, line_no, line, k, h, amount, CASE WHEN regexp_matches(near, '{X.TAX_IN}') THEN '税込' WHEN regexp_matches(near, '{X.TAX_OUT}') THEN '税別' ELSE '不明' END AS tax,
regexp_extract(near, '{X.UNIT}', 1) AS unit, array_to_string(list_slice(list_filter(names, lambda x: contains(lower(near), lower(x))), 1, 4), '|') AS tokens, {_SCORE} AS score FROM h, n WHERE amount BETWEEN {X.LOWEST} AND {X.HIGHEST}),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id, amount, tax, unit, line ORDER BY line_no, k, h) AS o FROM f)
SELECT * FROM (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, amount, line_no, k, h) AS BIGINT) AS place, CAST(line_no AS BIGINT) AS line_no, amount, tax, unit, tokens, CAST(score AS BIGINT) AS score FROM o WHERE o = 1) WHERE place <= 30"""


@query(_PRICES)
def line_price_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts by line with tax, unit, products and score of the lines around, the thirty best of each document."""
    p = X.line_prices(load(spark, sf_dir, "documents"), "doc_id", "text", RULES, _product_list(spark, sf_dir))
    return p.select("doc_id", "place", "line_no", "amount", "tax", "unit", F.array_join("tokens", "|").alias("tokens"), "score")


@query(_PRICES.replace("BETWEEN 2 PRECEDING AND 2 FOLLOWING", "BETWEEN 3 PRECEDING AND 3 FOLLOWING"))
def line_price_candidates_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with three lines on either side."""
    p = X.line_prices(load(spark, sf_dir, "documents"), "doc_id", "text", RULES, _product_list(spark, sf_dir), 3)
    return p.select("doc_id", "place", "line_no", "amount", "tax", "unit", F.array_join("tokens", "|").alias("tokens"), "score")


_UNITS = ", ".join(f"regexp_replace(regexp_extract(unit, '{p}', 1), '\\s+', '', 'g')" for p in X.UNITS)


@query(f"""SELECT row_id, CASE WHEN regexp_matches(t, '{X.TAX_IN}') THEN '税込' WHEN regexp_matches(t, '{X.TAX_OUT}') THEN '税別' ELSE '不明' END AS tax, regexp_extract(unit, '{X.UNIT}', 1) AS unit,
array_to_string(list_slice(list_filter(v, lambda x, i: x <> '' AND list_position(v, x) = i), 1, 3), '・') AS units FROM (SELECT row_id, concat_ws(' ', tax, unit) AS t, unit, [{_UNITS}] AS v FROM price_stage WHERE unit IS NOT NULL)""")
def tax_and_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, u = load(spark, sf_dir, "price_stage").where("unit is not null"), F.col("unit")
    return p.select("row_id", X.tax_of(F.concat_ws(" ", "tax", "unit")).alias("tax"), X.unit_of(u).alias("unit"), X.units_of(u).alias("units"))


@query("""SELECT doc_id, array_to_string(list_slice(list_filter(names, lambda x: contains(lower(text), lower(x))), 1, 4), '|') AS tokens FROM documents, (SELECT list(product ORDER BY product_id) AS names FROM product_registry)""")
def product_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four products of the list that a document names, one inside another counted as well."""
    return load(spark, sf_dir, "documents").select("doc_id", F.array_join(X.tokens_in(F.col("text"), _product_list(spark, sf_dir)), "|").alias("tokens"))


@query(f"""WITH {_FLAT_LINES.replace("regexp_replace(text, '[ \\t\\f　\\x{a0}]+', ' ', 'g')", 'text')}, g AS (SELECT doc_id, substr(near, 1, 500) AS excerpt, min(line_no) AS line_no FROM near
WHERE regexp_matches(near, '{TREATMENT_WORDS}') AND regexp_matches(near, '料金|費用|価格') AND regexp_matches(near, '{CONTACT_WORDS}') GROUP BY 1, 2)
SELECT * FROM (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS BIGINT) AS place, excerpt FROM g) WHERE place <= 5""")
def without_public_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places where a treatment's price is left to an enquiry."""
    return X.without_prices(load(spark, sf_dir, "documents"), "doc_id", "text", TREATMENT_WORDS, "料金|費用|価格", CONTACT_WORDS)


@query("""SELECT plan_id, CASE """ + " ".join(f"WHEN treatment_class = '{k}' THEN coalesce(regexp_matches(treatment, '{p}'), false)" for k, p in COMPETING.items()) + """ ELSE false END AS rejected FROM treatment_plan""")
def rejected_by_competing_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "treatment_plan").select("plan_id", X.rejected_by_kind(F.col("treatment_class"), F.col("treatment"), COMPETING).alias("rejected"))


@query(f"""WITH {_FLAT_LINES.replace("regexp_replace(text, '[ \\t\\f　\\x{a0}]+', ' ', 'g')", 'text')}, k AS (SELECT doc_id, line_no, CASE WHEN regexp_matches(line, '{OUTSIDE_WORDS}') AND NOT regexp_matches(line, '{INSIDE_WORDS}') THEN 'outside' WHEN regexp_matches(line, '{INSIDE_WORDS}') AND NOT regexp_matches(line, '{OUTSIDE_WORDS}') THEN 'inside' END AS kind FROM lines)
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, last_value(kind IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS heading FROM k""")
def nearest_heading_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kind named by each line or the nearest of the three before it; a line that names both kinds names none."""
    lines = X.lines(load(spark, sf_dir, "documents"), "doc_id", "text")
    out, inside = F.col("line").rlike(OUTSIDE_WORDS), F.col("line").rlike(INSIDE_WORDS)
    kind = F.when(out & ~inside, "outside").when(inside & ~out, "inside")
    return L.preceding(lines, "doc_id", ["line_no"], kind, "heading", 3, True).select("doc_id", "line_no", "heading")


@query()
def amounts_in_char_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts with 150 characters before and 170 after, the twenty best of each document; SQL has no places of matches."""
    rules = [(PRICE_WORDS, 5), (TREATMENT_WORDS, 2), (TAX_WORDS, 1), (COURSE_WORDS, 1), (ANCILLARY_WORDS, -8)]
    a = X.amounts_in_context(load(spark, sf_dir, "documents"), "doc_id", "text", rules, _product_list(spark, sf_dir))
    return a.withColumn("tokens", F.array_join("tokens", "|"))


@query()
def nearest_label_before_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each amount with the nearest ancillary or treatment word at most 140 characters before it; SQL has no places of matches."""
    return X.labelled_before(load(spark, sf_dir, "documents"), "doc_id", "text", X.YEN_AMOUNT, {"ancillary": ANCILLARY_WORDS, "treatment": TREATMENT_WORDS})


@query()
def best_place_of_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each distinct amount of a document is best stated; SQL has no places of matches."""
    d = load(spark, sf_dir, "documents").select("doc_id", "text", X.amount_spans()("text").alias("a"), T.regex_spans(X.alternation(_product_list(spark, sf_dir)))("text").alias("t"))
    each = d.select("doc_id", "text", "a", "t", F.explode(F.array_distinct(F.transform("a", lambda x: x["amount"]))).alias("amount"))
    best = X.best_amount_place(F.col("text"), F.col("a"), F.col("amount"), F.col("t"), f"{PRICE_WORDS}|{TREATMENT_WORDS}")
    return each.select("doc_id", "amount", best.alias("b")).select("doc_id", "amount", "b.start", "b.end")


@query()
def amounts_added_from_excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first amount of each line with its surroundings, and the further amounts that these show; SQL has no places of matches."""
    first = X.line_amounts(load(spark, sf_dir, "documents"), "doc_id", "text").where("hit_no = 1").select("doc_id", "line_no", "amount", F.col("near").alias("excerpt"))
    return X.augmented(first, ["doc_id", "line_no"], "amount", "excerpt").select("doc_id", "line_no", "amount", "synthetic", "around")


@query()
def products_in_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products that a document names near its words on treatments; those of one token need them within 180 characters. SQL has no places of matches."""
    names = _product_list(spark, sf_dir)
    words = {n: X.alternation([n]) for n in names}
    return X.hits_in_context(load(spark, sf_dir, "documents"), "doc_id", "text", words, "多血小板|血小板|再生医療|遠心|platelet|drawn and prepared", near=[n for n in names if " " not in n])


_HOME = f"{Q.compact('n')}"


@query(f"""WITH f AS (SELECT facility_id, {Q.strip_legal(_HOME)} AS stem FROM (SELECT facility_id, {Q.nfkc('f')} AS n FROM (SELECT facility_id, arg_min(facility, plan_id) FILTER (facility <> '') AS f FROM treatment_plan GROUP BY 1)))
SELECT doc_id, coalesce(length(stem) >= 5 AND (contains(coalesce(title, ''), stem) OR contains(coalesce(home, ''), stem)), false) AS official FROM (SELECT doc_id, facility_id, {Q.compact("string_split(text, chr(10))[1]")} AS title, {_HOME.replace('(n,', '(text,')} AS home FROM documents) JOIN f USING (facility_id)""")
def official_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the text or its first line names the facility it is filed under."""
    raw = lambda c: F.lower(F.regexp_replace(c, T.PUNCTUATION, ""))
    f = A.first_nonempty(load(spark, sf_dir, "treatment_plan"), ["facility_id"], ["facility"], "plan_id").select("facility_id", T.strip_legal(T.compact(F.col("facility"))).alias("stem"))
    d = load(spark, sf_dir, "documents").select("doc_id", "facility_id", raw(F.get(F.split("text", "\n"), F.lit(0))).alias("title"), raw(F.col("text")).alias("home"))
    return d.join(f, "facility_id").select("doc_id", X.is_official(F.col("title"), F.col("home"), F.array("stem")).alias("official"))
