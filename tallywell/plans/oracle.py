"""The same questions as plain SQL over the same tables, for comparison with the Spark results."""

from __future__ import annotations

# Written out, so that a wrong value in the code under test shows.
POSITIVE = [("the", "Appearance", 1), ("of", "Aroma", 2), ("de", "Flavor", 1), ("der", "Flavor", 2),
            ("la", "PriceValue", 1), ("is", "Availability", 3)]
NEGATIVE = [("and", "Flavor", 1), ("to", "PackagingDesign", 2), ("que", "Aroma", 2), ("le", "PriceValue", 1),
            ("und", "ShelfLifeStorage", 2), ("die", "Appearance", 1), ("it", "SocialAcceptability", 3)]
SCENE = [(t, None, 1) for t in ("with", "for", "mit", "por", "pour", "dans")]
PRICE_CODES = ["under100k", "100k_199k", "200k_299k", "300kplus"]
GATE, SEARCH_TERM = 0.6, "thes"
CATEGORIES = ["Appearance", "Aroma", "Flavor", "MouthfeelCarbonation", "DrinkabilityAftertaste", "ABV", "CaloriesCarbs",
              "AdditivesAllergen", "Ingredients", "PackagingDesign", "PackServingFormat", "ShelfLifeStorage", "PriceValue",
              "Availability", "PromotionVisibility", "BrandImageStory", "SocialAcceptability", "SustainabilityEthics"]
REGIONS = ["hokkaido_to_hoku", "kanto", "chubu", "kinki", "chugoku_shikoku", "kyushu_okinawa", "overseas", "no_answer"]
OCCUPATIONS = ["company_employee", "student", "homemaker", "other"]
PRICE_BANDS = ["under199", "200_249", "250_299", "300_349", "350plus"]
SURVEY_COLUMNS = [
    "id", "submitted_at", "age_group", "gender", "occupation", "region", "drives_weekly", "drinking_freq", "fav_alcohols_arr",
    "nonalc_freq", "health_reasons_arr", "purchase_intent", "price_band", "satisfaction_int", "free_comment", "positive_point",
    "negative_feedback", "scene", "positive_point_category", "positive_point_confidence", "negative_feedback_category",
    "negative_feedback_confidence"]
_LONG, _TIME, _TEXT, _FLAG = ("LONG", "bigint"), ("TIMESTAMP", "timestamp"), ("STRING", "string"), ("BOOLEAN", "boolean")
_LIST, _INT, _NUMBER = ("ARRAY", "array<string>"), ("INT", "int"), ("DOUBLE", "double")
SURVEY_TYPES = [_LONG, _TIME, _TEXT, _TEXT, _TEXT, _TEXT, _FLAG, _TEXT, _LIST, _TEXT, _LIST, _TEXT, _TEXT, _INT, _TEXT, _LIST,
                _LIST, _LIST, _TEXT, _NUMBER, _TEXT, _NUMBER]
Terms = list[tuple[str, str | None, int]]

A1 = """a1 AS (
  SELECT o_orderkey AS id, o_orderdate AS submitted_at,
    CASE WHEN o_orderkey % 11 <> 0 THEN
      CASE o_orderkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'other' ELSE 'no_answer' END
    END AS gender,
    c_mktsegment AS occupation, r_name AS region, o_orderkey % 2 = 0 AS drives_weekly,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS satisfaction_int,
    CASE o_orderstatus WHEN 'F' THEN 'def_buy' WHEN 'O' THEN 'maybe' WHEN 'P' THEN 'no' END AS purchase_intent,
    CASE WHEN o_totalprice < 100000 THEN 'under100k' WHEN o_totalprice < 200000 THEN '100k_199k'
         WHEN o_totalprice < 300000 THEN '200k_299k' ELSE '300kplus' END AS price_band
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""
A2 = """a2 AS (SELECT DISTINCT l_orderkey AS id, p_type AS option
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
WORD = "[^a-zà-ÿ]+"
BLANKS = "' ' || chr(9) || chr(13) || chr(10) || '　'"


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _terms(lexicon: Terms) -> str:
    return "(VALUES " + ", ".join(f"('{t}', '{lab}', {w})" for t, lab, w in lexicon) + ") lex(term, label, weight)"


LABELS = "(VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(CATEGORIES, 1)) + ") labels18(label_no, label)"

SENTENCES = f"""sentence AS (
  SELECT id, unnest(ss) AS phrase, generate_subscripts(ss, 1) AS no FROM (
    SELECT doc_id AS id, list_filter(list_transform(string_split_regex(text, '[.!?\\n。！？]+'),
      lambda x: trim(x, {BLANKS})), lambda x: length(x) > 0) AS ss FROM documents))"""


def _found(lexicon: Terms, name: str) -> str:
    """Sentences with a term, once each, with the place they first stand at."""
    return f"""{name} AS (
  SELECT id, phrase, min(no) AS no FROM sentence
  WHERE len(list_filter(string_split_regex(lower(phrase), '{WORD}'),
    lambda w: list_contains([{_list(t for t, _, _ in lexicon)}], w))) > 0
  GROUP BY id, phrase)"""


def _phrases(lexicon: Terms) -> str:
    return f"""WITH {SENTENCES}, {_found(lexicon, 'found')},
    joined AS (SELECT id, count(*) AS n, string_agg(phrase, ' | ' ORDER BY no) AS phrases FROM found GROUP BY id)
    SELECT doc_id AS id, coalesce(n, 0) AS n, coalesce(phrases, '') AS phrases
    FROM documents LEFT JOIN joined ON doc_id = id"""


def _label(lexicon: Terms, name: str) -> str:
    """(id, category, confidence) of documents with a hit."""
    return f"""{name}_score AS (
      SELECT id, label, CAST(sum(weight) AS BIGINT) AS score
      FROM (SELECT doc_id AS id, unnest(string_split_regex(lower(text), '{WORD}')) AS w FROM documents)
      JOIN {_terms(lexicon)} ON w = term GROUP BY id, label),
    {name} AS (
      SELECT id, label AS category, round(score / sum(score) OVER (PARTITION BY id), 6) AS confidence
      FROM {name}_score JOIN {LABELS} USING (label)
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, label_no) = 1)"""


LABELLED = f"""{_label(POSITIVE, 'pos')}, {_label(NEGATIVE, 'neg')},
  labelled AS (SELECT doc_id AS id, lang AS segment, pos.category AS pos_category, pos.confidence AS pos_confidence,
    neg.category AS neg_category, neg.confidence AS neg_confidence
    FROM documents LEFT JOIN pos ON doc_id = pos.id LEFT JOIN neg ON doc_id = neg.id)"""

FEEDBACK = f"""{SENTENCES}, lex AS (
      SELECT 1 AS polarity, * FROM {_terms(POSITIVE)} UNION ALL SELECT -1, * FROM {_terms(NEGATIVE)}),
    word AS (SELECT id, no, phrase, unnest(string_split_regex(lower(phrase), '{WORD}')) AS w FROM sentence),
    score AS (SELECT id, polarity, no, phrase, label, CAST(sum(weight) AS BIGINT) AS score
      FROM word JOIN lex ON w = term GROUP BY ALL),
    best AS (SELECT score.* FROM score JOIN {LABELS} USING (label)
      QUALIFY row_number() OVER (PARTITION BY id, polarity, no ORDER BY score DESC, label_no) = 1),
    feedback AS (SELECT id, CAST(polarity AS INTEGER) AS polarity,
      CAST(row_number() OVER (PARTITION BY id, polarity ORDER BY no) AS INTEGER) AS phrase_no, phrase, label, score FROM best)"""


def _domain(column: str, kind: str, ok: str) -> str:
    return f"""SELECT '{column}' AS "column", '{kind}' AS kind, CAST({column} AS VARCHAR) AS value, count(*) AS n
    FROM a1 WHERE NOT ({ok}) GROUP BY 3"""


def _completeness() -> str:
    have = {"id", "submitted_at", "gender", "occupation", "region", "drives_weekly", "satisfaction_int",
            "purchase_intent", "price_band"}
    text = {"gender", "occupation", "region", "purchase_intent", "price_band"}
    rows = []
    for c in SURVEY_COLUMNS:
        if c not in have:
            rows.append(f"SELECT '{c}' AS \"column\", count(*) AS n, 1.0::DOUBLE AS null_rate, 0.0::DOUBLE AS empty_rate, 0.0::DOUBLE AS na_rate FROM a1")
            continue
        empty = f"avg(CASE WHEN trim({c}, {BLANKS}) = '' THEN 1.0 ELSE 0.0 END)" if c in text else "0.0::DOUBLE"
        na = f"avg(CASE WHEN {c} = 'no_answer' THEN 1.0 ELSE 0.0 END)" if c in text else "0.0::DOUBLE"
        rows.append(f"SELECT '{c}' AS \"column\", count(*) AS n, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate, "
                    f"round({empty}, 6) AS empty_rate, round({na}, 6) AS na_rate FROM a1")
    return f"WITH {A1} " + " UNION ALL ".join(rows)


def _trend(unit: str, k: int, by: bool) -> str:
    label, part, same = ("label, ", "PARTITION BY label ", "AND f.label = e.label") if by else ("", "", "")
    return f"""WITH f AS (
      SELECT {'event_type AS label, ' if by else ''}date_trunc('{unit}', ts) AS bucket, count(*) AS n, avg(value) AS mean_score
      FROM events GROUP BY ALL),
    e AS (SELECT {label}unnest(generate_series(min(bucket)::TIMESTAMP, max(bucket)::TIMESTAMP, INTERVAL 1 {unit})) AS bucket
      FROM f {'GROUP BY label' if by else ''}),
    b AS (SELECT {'e.label AS label, ' if by else ''}e.bucket AS bucket, coalesce(n, 0) AS n, mean_score
      FROM e LEFT JOIN f ON f.bucket = e.bucket {same})
    SELECT {label}strftime(bucket, '%Y-%m-%d') AS bucket, n, round(mean_score, 6) AS mean_score,
      n - lag(n) OVER ({part}ORDER BY bucket) AS delta,
      round(avg(n) OVER ({part}ORDER BY bucket ROWS BETWEEN {k} PRECEDING AND CURRENT ROW), 6) AS ma FROM b"""


def _subtotals(grouping: str) -> str:
    return f"""WITH {A1} SELECT region, occupation, purchase_intent,
    CAST(grouping(region) AS INTEGER) AS region_total, CAST(grouping(occupation) AS INTEGER) AS occupation_total,
    CAST(grouping(purchase_intent) AS INTEGER) AS purchase_intent_total, count(*) AS n
    FROM a1 GROUP BY {grouping}"""


def _sets(op: str) -> str:
    of = lambda t: f"SELECT l_orderkey AS id FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type = '{t}'"
    return f"{of('PROMO')} {op} {of('ECONOMY')}"


def _index(cells: str, segment: str, label: str, k: int) -> str:
    return f"""cells AS (SELECT {segment} AS segment, {label} AS label, count(*) AS n FROM {cells}
      WHERE {segment} IS NOT NULL AND {label} IS NOT NULL GROUP BY ALL),
    idx AS (SELECT segment, label, n, round((n / sum(n) OVER (PARTITION BY segment))
      / (sum(n) OVER (PARTITION BY label) / sum(n) OVER ()) * 100, 6) AS idx FROM cells)
    SELECT segment, label, n, idx, row_number() OVER (PARTITION BY segment ORDER BY idx DESC, label) AS rank
    FROM idx QUALIFY rank <= {k}"""


def _pairs(answers: str, base: str, min_n: int) -> str:
    return f"""one AS (SELECT option, count(*) AS n FROM {answers} GROUP BY option),
    pair AS (SELECT x.option AS a, y.option AS b, count(*) AS n FROM {answers} x JOIN {answers} y
      ON x.id = y.id AND x.option < y.option GROUP BY ALL HAVING count(*) >= {min_n})
    SELECT a, b, pair.n AS n, round(pair.n / ({base}), 6) AS support, round(pair.n / oa.n, 6) AS confidence,
      round(CAST(pair.n AS DOUBLE) * ({base}) / (CAST(oa.n AS DOUBLE) * ob.n), 6) AS lift
    FROM pair JOIN one oa ON a = oa.option JOIN one ob ON b = ob.option"""


def _distinctive(k: int) -> str:
    return f"""WITH w AS (
        SELECT lang AS segment, unnest(string_split_regex(lower(text), '{WORD}')) AS term FROM documents),
      c AS (SELECT segment, term, count(*) AS n FROM w WHERE length(term) > 0 GROUP BY ALL),
      s AS (SELECT *, round(n * ln((SELECT count(DISTINCT segment)::DOUBLE FROM c)
        / (1 + count(*) OVER (PARTITION BY term))), 6) AS tfidf FROM c)
      SELECT segment, term, n, tfidf, row_number() OVER (PARTITION BY segment ORDER BY tfidf DESC, term) AS rank
      FROM s QUALIFY rank <= {k}"""


_SNIPPET = f"""substr(text, greatest(strpos(lower(text), '{SEARCH_TERM}') - 20, 1),
  strpos(lower(text), '{SEARCH_TERM}') - greatest(strpos(lower(text), '{SEARCH_TERM}') - 20, 1) + {len(SEARCH_TERM) + 20})"""

ORACLE_SQL = {
    "r01_scan_survey": f"""WITH {A1} SELECT * REPLACE (strftime(submitted_at, '%Y-%m-%d %H:%M:%S') AS submitted_at) FROM a1""",
    "r02_scan_dictionary": """SELECT CAST(doc_id AS VARCHAR) AS column_name, lang AS data_type, text AS comment FROM documents""",
    "r03_export_dictionary": f"WITH {A1} " + " UNION ALL ".join([
        _domain("gender", "violation", "gender IN ('male', 'female', 'other', 'no_answer')"),
        _domain("region", "violation", f"region IN ({_list(REGIONS)})"),
        _domain("occupation", "unlisted", f"occupation IN ({_list(OCCUPATIONS)})"),
        _domain("price_band", "unlisted", f"price_band IN ({_list(PRICE_BANDS)})"),
        _domain("purchase_intent", "violation", "purchase_intent IN ('def_buy', 'maybe', 'unsure', 'no')"),
        _domain("satisfaction_int", "violation", "satisfaction_int BETWEEN 1 AND 5"),
    ]),
    "r03_export_rows": f"""WITH d(column_name, data_type, read_type) AS (VALUES {", ".join(
        f"('{c}', '{a}', '{b}')" for c, (a, b) in zip(SURVEY_COLUMNS, SURVEY_TYPES, strict=True))})
      SELECT *, (SELECT count(*) FROM orders) AS n FROM d""",
    "b05_csat_valid": f"""WITH {A1} SELECT gender, count(*) AS n, round(avg(satisfaction_int), 6) AS mean,
      round(stddev_samp(satisfaction_int), 6) AS sd,
      round(avg(CASE WHEN satisfaction_int >= 4 THEN 1.0e0 ELSE 0.0e0 END), 6) AS top2,
      round(avg(CASE WHEN satisfaction_int <= 2 THEN 1.0e0 ELSE 0.0e0 END), 6) AS bottom2
      FROM a1 WHERE gender IS NOT NULL AND gender <> 'no_answer' GROUP BY gender""",
    "r04_type_submitted_at": """SELECT o_orderkey AS id,
      CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS submitted_at,
      CASE WHEN o_orderkey % 10 <> 0 THEN CAST(epoch(o_orderdate) AS BIGINT) END AS submitted_epoch FROM orders""",
    "r05_type_boolean": """SELECT o_orderkey AS id,
      CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 2 = 0 END AS drives_weekly FROM orders""",
    "r06_multi_select_to_array": f"""WITH {A2} SELECT id, count(*) AS n, string_agg(option, '|' ORDER BY option) AS options
      FROM a2 GROUP BY id""",
    "r07_satisfaction_to_int": """SELECT o_orderkey AS id,
      CASE WHEN o_orderkey % 7 <> 0 THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS satisfaction_int FROM orders""",
    "r08_band": """SELECT o_orderkey AS id, CASE WHEN o_totalprice < 100000 THEN 'under100k'
      WHEN o_totalprice < 200000 THEN '100k_199k' WHEN o_totalprice < 300000 THEN '200k_299k' ELSE '300kplus' END AS price_band
      FROM orders""",
    "r08_band_table": """SELECT o_orderkey AS id, CASE WHEN o_totalprice >= 0 AND o_totalprice < 500000
        AND CAST(floor(o_totalprice / 50) AS BIGINT) % 7 <> 3 THEN 'b' || CAST(floor(o_totalprice / 50) AS BIGINT) END AS price_band FROM orders""",
    "r15_enrich": f"""WITH {LABELLED}, {SENTENCES}, {_found(POSITIVE, 'p')}, {_found(NEGATIVE, 'n')}, {_found(SCENE, 's')},
      x AS (SELECT id, 1 AS k, phrase, no FROM p UNION ALL SELECT id, 2, phrase, no FROM n UNION ALL SELECT id, 3, phrase, no FROM s),
      j AS (SELECT id, {", ".join(f"coalesce(string_agg(phrase, ' | ' ORDER BY no) FILTER (WHERE k = {k}), '') AS j{k}" for k in (1, 2, 3))}
        FROM x GROUP BY id)
      SELECT labelled.id AS id, segment, coalesce(j1, '') AS positive_point, coalesce(j2, '') AS negative_feedback, coalesce(j3, '') AS scene,
        pos_category AS positive_point_category, pos_confidence AS positive_point_confidence,
        neg_category AS negative_feedback_category, neg_confidence AS negative_feedback_confidence
      FROM labelled LEFT JOIN j ON j.id = labelled.id""",
    "b13_segment_index_all": f"WITH {A1}, " + _index("a1", "region", "price_band", 5000),
    "b17_distinctive_terms_many": _distinctive(2000),
    "r09_extract_positive": _phrases(POSITIVE),
    "r10_extract_negative": _phrases(NEGATIVE),
    "r11_extract_scene": _phrases(SCENE),
    "r12_classify_positive": f"""WITH {LABELLED} SELECT id, pos_category AS positive_point_category FROM labelled""",
    "r12_classify_long_list": f"""WITH {_label(POSITIVE, 'pos')}
      SELECT doc_id AS id, category AS positive_point_category, confidence FROM documents LEFT JOIN pos ON doc_id = id""",
    "r09_extract_long_list": _phrases(POSITIVE),
    "r16_feedback_rows_long_list": f"""WITH {FEEDBACK} SELECT * FROM feedback""",
    "r01_scan_survey_all": f"""WITH {A1}, {A2}, o AS (
        SELECT id, string_agg(option, '|' ORDER BY option) AS o, min(option) AS first FROM a2 GROUP BY id)
      SELECT a1.id AS id, strftime(submitted_at, '%Y-%m-%d %H:%M:%S') AS submitted_at,
        CASE WHEN a1.id % 3 = 0 THEN '20s' ELSE '60plus' END AS age_group, gender, occupation, region, drives_weekly,
        'weekly' AS drinking_freq, o AS fav_alcohols_arr, 'sometimes' AS nonalc_freq, first AS health_reasons_arr,
        purchase_intent, price_band, satisfaction_int, 'No. ' || a1.id AS free_comment, o AS positive_point,
        o AS negative_feedback, CASE WHEN a1.id % 2 = 1 THEN o END AS scene, 'Aroma' AS positive_point_category,
        CASE WHEN a1.id % 13 <= 10 THEN (a1.id % 13) / 10.0::DOUBLE END AS positive_point_confidence,
        'ABV' AS negative_feedback_category, (a1.id % 7) / 10.0::DOUBLE AS negative_feedback_confidence
      FROM a1 JOIN o ON a1.id = o.id""",
    "r18_check_raw_answers": """WITH r AS (SELECT o_orderkey % 10 AS k, substr(o_orderpriority, 1, 1) AS d FROM orders),
      f AS (SELECT 'submitted_at' AS "column", 'unreadable' AS kind, CASE k WHEN 0 THEN 'n/a' ELSE '2024-13-01' END AS value FROM r WHERE k < 2
        UNION ALL SELECT 'drives_weekly', 'unreadable', 'maybe so' FROM r WHERE k = 2
        UNION ALL SELECT 'satisfaction_int', 'violation', d || CASE k WHEN 3 THEN '.5' ELSE '0' END FROM r WHERE k IN (3, 5))
      SELECT "column", kind, value, count(*) AS n FROM f GROUP BY ALL""",
    "b08_price_acceptance_unlisted": f"""WITH {A1}, i AS (SELECT DISTINCT purchase_intent AS intent FROM a1),
      o AS (SELECT unnest(['free', 'under100k', '100k_199k', '200k_299k']) AS band, unnest([1, 2, 3, 4]) AS r),
      t AS (SELECT purchase_intent AS intent, count(*) AS base, count(*) FILTER (WHERE price_band = '300kplus') AS odd FROM a1 GROUP BY 1),
      c AS (SELECT i.intent, o.band, o.r, (SELECT count(*) FROM a1 WHERE purchase_intent = i.intent AND price_band = o.band) AS n FROM i CROSS JOIN o)
      SELECT c.intent AS intent, band, n, round(sum(n) OVER (PARTITION BY c.intent ORDER BY r DESC ROWS UNBOUNDED PRECEDING) / base, 6) AS cum_share,
        round(odd / base, 6) AS unlisted_share FROM c JOIN t ON t.intent = c.intent""",
    "b10_pivot_table_unlisted": f"""WITH {A1} SELECT region, count(*) FILTER (WHERE gender = 'female') AS female,
      count(*) FILTER (WHERE gender = '0.00%') AS "0.00%", count(*) FILTER (WHERE gender NOT IN ('female', '0.00%')) AS "(other)",
      count(*) FILTER (WHERE gender IS NULL) AS "(missing)" FROM a1 GROUP BY region""",
    "r13_classify_negative": f"""WITH {LABELLED} SELECT id, neg_category AS negative_feedback_category FROM labelled""",
    "r14_confidence_positive": f"""WITH {LABELLED} SELECT id, pos_confidence AS positive_point_confidence FROM labelled""",
    "r15_confidence_negative": f"""WITH {LABELLED} SELECT id, neg_confidence AS negative_feedback_confidence FROM labelled""",
    "r16_feedback_rows": f"""WITH {FEEDBACK} SELECT * FROM feedback""",
    "r16_join_feedback": f"""WITH {FEEDBACK} SELECT id, lang AS segment, polarity, phrase_no, label, score
      FROM documents JOIN feedback ON doc_id = id""",
    "r16_join_feedback_left": f"""WITH {A1}, {A2} SELECT a1.id AS id, price_band, option FROM a1 LEFT JOIN a2 ON a1.id = a2.id""",
    "r16_join_feedback_semi": f"""WITH {A1} SELECT id, price_band FROM a1 WHERE id IN (SELECT l_orderkey FROM lineitem)""",
    "r16_join_feedback_anti": f"""WITH {A1} SELECT id, price_band FROM a1
      WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = id)""",
    "r17_check_primary_key": """SELECT l_orderkey AS id, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
    "r18_check_domains": f"WITH {A1} " + " UNION ALL ".join([
        _domain("gender", "violation", "gender IN ('male', 'female', 'other')"),
        _domain("purchase_intent", "violation", "purchase_intent IN ('def_buy', 'maybe')"),
        _domain("price_band", "unlisted", f"price_band IN ({_list(PRICE_CODES[:3])})"),
        _domain("satisfaction_int", "violation", "satisfaction_int BETWEEN 2 AND 4"),
    ]),
    "r19_reconcile_types": f"""WITH {A2} SELECT id,
      CASE WHEN id % 3 <> 2 THEN string_agg(option, '|' ORDER BY option) END AS options,
      CASE WHEN (id % 130) // 100 + (id % 100) / 100.0 <= 1 THEN round((id % 130) // 100 + (id % 100) / 100.0, 6)::DOUBLE END AS confidence
      FROM a2 GROUP BY id""",
    "b01_freq_single": f"""WITH {A1} SELECT region AS code, count(*) AS n, round(count(*) / (SELECT count(*) FROM a1), 6) AS share
      FROM a1 GROUP BY region""",
    "b01_freq_single_valid": f"""WITH {A1}, v AS (SELECT gender FROM a1 WHERE gender IS NOT NULL AND gender <> 'no_answer')
      SELECT gender AS code, count(*) AS n, round(count(*) / (SELECT count(*) FROM v), 6) AS share FROM v GROUP BY gender""",
    "b02_freq_multi": f"""WITH {A2} SELECT option, count(DISTINCT id) AS n,
      round(count(DISTINCT id) / (SELECT count(DISTINCT id) FROM a2), 6) AS share FROM a2 GROUP BY option""",
    "b03_crosstab": f"""WITH {A1}, c AS (SELECT region, price_band, count(*) AS n FROM a1 GROUP BY ALL)
      SELECT region, price_band, n, round(n / sum(n) OVER (PARTITION BY region), 6) AS row_share,
      round(n / sum(n) OVER (PARTITION BY price_band), 6) AS col_share, round(n / sum(n) OVER (), 6) AS total_share FROM c""",
    "b04_crosstab_multi": f"""WITH {A1}, {A2}, base AS (
      SELECT price_band, count(*) AS base FROM a1 WHERE id IN (SELECT id FROM a2) GROUP BY ALL)
      SELECT price_band, option, count(*) AS n, round(count(*) / any_value(base), 6) AS share
      FROM a1 JOIN a2 USING (id) JOIN base USING (price_band) GROUP BY price_band, option""",
    "b05_csat": f"""WITH {A1} SELECT region, count(*) AS n, round(avg(satisfaction_int), 6) AS mean,
      round(stddev_samp(satisfaction_int), 6) AS sd,
      round(avg(CASE WHEN satisfaction_int >= 4 THEN 1.0e0 ELSE 0.0e0 END), 6) AS top2,
      round(avg(CASE WHEN satisfaction_int <= 2 THEN 1.0e0 ELSE 0.0e0 END), 6) AS bottom2 FROM a1 GROUP BY region""",
    "b06_subtotals_rollup": _subtotals("ROLLUP (region, occupation, purchase_intent)"),
    "b06_subtotals_cube": _subtotals("CUBE (region, occupation, purchase_intent)"),
    "b06_subtotals_sets": _subtotals("GROUPING SETS ((region, occupation), (purchase_intent), ())"),
    "b07_purchase_rate": f"""WITH {A1} SELECT occupation, count(*) AS n,
      round(avg(CASE WHEN purchase_intent = 'def_buy' THEN 1.0e0 ELSE 0.0e0 END), 6) AS def_rate,
      round(avg(CASE WHEN purchase_intent IN ('def_buy', 'maybe') THEN 1.0e0 ELSE 0.0e0 END), 6) AS soft_rate
      FROM a1 GROUP BY occupation""",
    "b08_price_acceptance": f"""WITH {A1}, c AS (
      SELECT purchase_intent AS intent, price_band AS band, count(*) AS n,
        list_position([{_list(PRICE_CODES)}], price_band) AS r FROM a1 GROUP BY ALL)
      SELECT intent, band, n, round(sum(n) OVER (PARTITION BY intent ORDER BY r DESC ROWS UNBOUNDED PRECEDING)
        / sum(n) OVER (PARTITION BY intent), 6) AS cum_share, 0.0::DOUBLE AS unlisted_share FROM c""",
    "b09_association": f"""WITH {A1}, r AS (SELECT region, count(*) AS rn FROM a1 GROUP BY ALL),
      c AS (SELECT price_band, count(*) AS cn FROM a1 GROUP BY ALL), t AS (SELECT count(*) AS n FROM a1),
      o AS (SELECT region, price_band, count(*) AS o FROM a1 GROUP BY ALL),
      e AS (SELECT rn * cn / t.n AS e, coalesce(o, 0) AS o, t.n AS n FROM r CROSS JOIN c CROSS JOIN t
            LEFT JOIN o ON o.region = r.region AND o.price_band = c.price_band),
      x AS (SELECT any_value(n) AS n, sum((o - e) * (o - e) / e) AS chi2 FROM e)
      SELECT n, round(chi2, 6) AS chi2, (SELECT (count(*) - 1) FROM r) * (SELECT count(*) - 1 FROM c) AS dof,
        round(sqrt(chi2 / (n * least((SELECT count(*) - 1 FROM r), (SELECT count(*) - 1 FROM c)))), 6) AS v FROM x""",
    "b10_pivot_table": f"""WITH {A1} SELECT region, {", ".join(
        f'count(*) FILTER (WHERE price_band = {chr(39)}{c}{chr(39)}) AS "{c}"' for c in PRICE_CODES)}, 0 AS "(other)",
        count(*) FILTER (WHERE price_band IS NULL) AS "(missing)" FROM a1 GROUP BY region""",
    "b11_category_balance": f"""WITH {LABELLED}, p AS (SELECT pos_category AS label, count(*) AS pos FROM labelled GROUP BY 1),
      q AS (SELECT neg_category AS label, count(*) AS neg FROM labelled GROUP BY 1)
      SELECT CAST(label_no AS INTEGER) AS label_no, l.label AS label, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg,
        CASE WHEN coalesce(pos, 0) + coalesce(neg, 0) > 0 THEN
          round((coalesce(pos, 0) - coalesce(neg, 0)) / (coalesce(pos, 0) + coalesce(neg, 0)), 6) END AS net
      FROM (SELECT * FROM {LABELS}) l LEFT JOIN p ON p.label = l.label LEFT JOIN q ON q.label = l.label""",
    "b12_confidence_gate": f"""WITH {LABELLED} SELECT id, segment, pos_category AS positive_point_category,
      pos_confidence AS positive_point_confidence FROM labelled WHERE pos_confidence >= {GATE}""",
    "b12_review_queue": f"""WITH {LABELLED} SELECT id, pos_category AS positive_point_category,
      pos_confidence AS positive_point_confidence FROM labelled WHERE pos_confidence < {GATE}
      ORDER BY pos_confidence, id LIMIT 25""",
    "b13_segment_index": f"WITH {LABELLED}, " + _index("labelled", "segment", "pos_category", 3),
    "b13_segment_index_coded": f"WITH {A1}, " + _index("a1", "region", "price_band", 2),
    "b14_co_occurrence": f"WITH {A2}, " + _pairs("a2", "SELECT count(DISTINCT id) FROM a2", 1),
    "b14_co_occurrence_phrases": f"WITH {SENTENCES}, {_found(SCENE, 'found')}, named AS (SELECT id, phrase AS option FROM found), "
                                 + _pairs("named", "SELECT count(*) FROM documents", 2),
    "b15_phrase_topk": f"""WITH {SENTENCES}, {_found(POSITIVE, 'found')},
      c AS (SELECT phrase, count(*) AS n FROM found GROUP BY phrase)
      SELECT phrase, n, row_number() OVER (ORDER BY n DESC, phrase) AS rank FROM c QUALIFY rank <= 50""",
    "b15_phrase_topk_sketched": f"""WITH w AS (
        SELECT unnest(list_distinct(string_split_regex(lower(text), '{WORD}'))) AS phrase FROM documents),
      c AS (SELECT phrase, count(*) AS n FROM w WHERE length(phrase) > 0 GROUP BY 1)
      SELECT phrase, n, row_number() OVER (ORDER BY n DESC, phrase) AS rank, n * 8192 > 7 * sum(n) OVER () AS sure
      FROM c QUALIFY rank <= 50""",
    "b16_text_ngrams": """WITH t AS (SELECT regexp_extract_all(text, '(?s).') AS c FROM documents),
      g AS (SELECT unnest(list_transform(range(1, len(c)), lambda i: c[i] || c[i + 1])) AS gram FROM t)
      SELECT gram, count(*) AS n FROM g GROUP BY 1""",
    "b17_distinctive_terms": _distinctive(10),
    "b18_trend": _trend("week", 2, True),
    "b18_trend_daily": _trend("day", 6, False),
    "b19_driver_gap": f"""WITH {A1}, m AS (
        SELECT o.label AS label, avg(s) FILTER (WHERE occupation = label) AS m1, avg(s) FILTER (WHERE occupation <> label) AS m0,
          var_samp(s) FILTER (WHERE occupation = label) AS v1, var_samp(s) FILTER (WHERE occupation <> label) AS v0,
          count(*) FILTER (WHERE occupation = label) AS n1, count(*) FILTER (WHERE occupation <> label) AS n0
        FROM (SELECT DISTINCT occupation AS label FROM a1) o CROSS JOIN (SELECT occupation, satisfaction_int AS s FROM a1) GROUP BY 1)
      SELECT label, n1, n0, round(m1 - m0, 6) AS gap, round((m1 - m0) / sqrt(v1 / n1 + v0 / n0), 6) AS t FROM m""",
    "b20_respondent_sets_and": _sets("INTERSECT"),
    "b20_respondent_sets_minus": _sets("EXCEPT"),
    "b20_respondent_sets_or": _sets("UNION"),
    "b21_comment_search": f"""WITH {LABELLED} SELECT id, pos_category AS label, {_SNIPPET} AS snippet
      FROM documents JOIN labelled ON doc_id = id WHERE contains(lower(text), '{SEARCH_TERM}')""",
    "b21_best_examples": f"""WITH {LABELLED} SELECT id, pos_category AS label, {_SNIPPET} AS snippet,
      row_number() OVER (PARTITION BY pos_category ORDER BY pos_confidence DESC, id) AS rank
      FROM documents JOIN labelled ON doc_id = id
      WHERE contains(lower(text), '{SEARCH_TERM}') AND pos_category IS NOT NULL QUALIFY rank <= 3""",
    "b22_completeness": _completeness(),
    "s01_stream_dedupe": """SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS submitted_at, event_type AS label FROM events""",
    "s02_stream_tally": """WITH t AS (SELECT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS w, event_type AS label FROM events)
      SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, label, count(*) AS n FROM t
      WHERE w + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY ALL""",
}
