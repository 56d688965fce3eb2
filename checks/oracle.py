"""The same results in DuckDB SQL, written apart from the library.

DuckDB's regex engine has no lookahead, possessive loops or Unicode ``\\b``; these queries use
consuming groups, markers and list functions instead.
"""

from __future__ import annotations

from checks import derive as D
from checks.queries import STOP_WORDS
from shelfmark.operators.reports import REPORTS

ORACLE: dict[str, str] = {}

WEIGHT = r"(\d+(?:\.\d+)?)\s*(KG|KGS|G|GM|GR|GRAM|GRAMS|L|LTR|LITRE|ML|M L|LT)(?:[\s*×X0-9]|[^\p{L}\p{N}_]|$)"


def weight(name: str) -> str:
    m = lambda group: f"regexp_extract(upper({name}), '{WEIGHT}', {group})"
    return f"""CASE WHEN {m(1)} <> '' THEN CAST(CAST(round_even(CAST({m(1)} AS DOUBLE) *
      CASE WHEN {m(2)} IN ('KG','KGS','L','LTR','LITRE') THEN 1000 ELSE 1 END, 0) AS BIGINT) AS VARCHAR) || 'G' END"""


def units(name: str, early: bool = False) -> str:
    up = f"upper({name})"
    pieces, tail = ("PCS|PC", "") if early else ("PCS|PC|PS", "|MIL|OZ")
    rules = [
        rf"(\d+)\s*(?:{pieces})\b",
        r"\(\s*[\d.]+\s*(?:ML|L|G|KG)?\s*[*×X]\s*(\d+)\s*\)",
        rf"(\d+)\s*[*×X]\s*[\d.]+\s*(?:ML|L|LTR|G|KG{tail})",
        "chain",
        r"\b(\d+)\s*[X×]\s*\d*\s*(?:KG|G|GM|L|ML)\b",
    ]
    if not early:
        rules += [r"\b(\d+)\s*(?:BAG|BAGS|TEABAG|TEABAGS|TEA BAGS|STICKS)\b", "plus"]
    rules.append(r"[*×X]\s*(\d+)")
    # The digits that follow a cross must stay available to the next match: mark them first.
    marked = rf"regexp_replace({up}, '([X×]\s*)(\d)', '\1' || chr(1) || '\2', 'g')"
    chain = rf"regexp_extract_all({marked}, '(\d+)\s*[X×]\s*' || chr(1), 1)"
    plus = r"(\d+)\s*\+\s*(\d+)"
    cases = []
    for rule in rules:
        if rule == "chain":
            product = f"list_product(list_transform({chain}, lambda x: CAST(x AS BIGINT)))"
            cases.append(f"WHEN len({chain}) > 0 THEN CAST({product} AS BIGINT)")
        elif rule == "plus":
            part = lambda n: f"CAST(regexp_extract({up}, '{plus}', {n}) AS BIGINT)"
            cases.append(f"WHEN regexp_matches({up}, '{plus}') THEN {part(1)} + {part(2)}")
        else:
            cases.append(f"WHEN regexp_matches({up}, '{rule}') THEN CAST(regexp_extract({up}, '{rule}', 1) AS BIGINT)")
    return "CASE " + " ".join(cases) + " END"


def packaging(name: str) -> str:
    return f"CASE WHEN regexp_matches({name}, '(?i)ctn|carton') THEN 'CTN' ELSE 'NON-CTN' END"


UNIT_PACKAGING = f"CASE WHEN upper(trim({D.UNIT})) = 'CTN' THEN 'CTN' ELSE 'NON-CTN' END"
NAMES = "CASE " + D.BRAND_CLASS + " " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(D.SUPPLIERS)) + " END"

CATALOG = f"""catalog AS (
  SELECT {D.BRAND_CLASS} AS source, p_partkey, {NAMES} AS "Supplier", {D.PACKED_NAME} AS "Product_Name",
    CAST(p_partkey AS VARCHAR) AS "Serial_Number", {UNIT_PACKAGING} AS from_unit FROM part),
extracted AS (
  SELECT source, p_partkey, "Supplier", "Product_Name", "Serial_Number", {weight('"Product_Name"')} AS "Weight_Quantity",
    {units('"Product_Name"')} AS "Units_Per_Carton",
    CASE WHEN "Supplier" = '{D.UNIT_SUPPLIER}' THEN from_unit ELSE {packaging('"Product_Name"')} END AS "Packaging_Type"
  FROM catalog),
clean AS (
  SELECT 'product_' || row_number() OVER (ORDER BY source, p_partkey) AS "Product_ID", "Product_Name", "Serial_Number",
    "Supplier", "Weight_Quantity", "Packaging_Type", "Units_Per_Carton", p_partkey, source
  FROM (SELECT *, min(p_partkey) OVER (PARTITION BY "Product_Name", "Supplier") AS first_key FROM extracted)
  WHERE p_partkey = first_key)"""
CLEAN = 'SELECT "Product_ID", "Product_Name", "Serial_Number", "Supplier", "Weight_Quantity", "Packaging_Type", "Units_Per_Carton"'

# Sources and sinks.
ORACLE["s01_read_catalogs"] = f'WITH {CATALOG} SELECT "Supplier", "Serial_Number", "Product_Name", "Packaging_Type" FROM extracted'
ORACLE["s02_null_tokens"] = "SELECT p_partkey, CASE p_partkey % 6 WHEN 4 THEN 'Nan' WHEN 5 THEN p_name END AS value FROM part"
ORACLE["s03_write_catalog"] = f"WITH {CATALOG} {CLEAN} FROM clean"
ORACLE["s04_load_master"] = f"""WITH {CATALOG} {CLEAN}, "Supplier" AS "Source_File", '{D.AS_OF}' AS "Last_Updated" FROM clean"""
ORACLE["s01_quoted_breaks"] = f"SELECT CAST(p_partkey AS VARCHAR) AS serial, {D.BROKEN_NAME} AS name, p_brand AS brand FROM part"
_MISSING = "'product name column missing in the catalog of S' || n"
ORACLE["p02_required_column"] = f"""SELECT 'S' || n AS "Supplier", p_partkey AS "Serial_Number", CASE n WHEN 1 THEN p_name WHEN 2 THEN p_type END AS "Product_Name",
 CASE WHEN n IN (0, 3) THEN {_MISSING} END AS error FROM part, (SELECT unnest([0, 1, 2, 3]) AS n)"""
ORACLE["p03_missing_serial"] = """SELECT 'East' AS "Supplier", CAST(NULL AS VARCHAR) AS "Serial_Number", p_name AS "Product_Name", p_brand AS "Brand" FROM part"""
ORACLE["s05_read_records"] = D.WIDE
ORACLE["s05_list"] = D.WIDE
ORACLE["s05_keyed"] = f"""SELECT serial_number AS id, serial_number, input_title, url_1, url_1_title, url_2, url_2_title, url_3, url_3_title,
 url_4, url_4_title, url_5, url_5_title FROM ({D.WIDE})"""
ORACLE["s05_quarantine"] = f"""SELECT CASE WHEN CAST(id AS INT) % 3 = 0 THEN 'set aside' ELSE 'record' END AS kind,
 CASE CAST(id AS INT) % 9 WHEN 0 THEN '{{"id":{{"x":' || id || '}}}}' WHEN 3 THEN id WHEN 6 THEN '{{"id":"' || id || '","url_1":["' || url_1 || '"]}}'
 ELSE id || '|' || input_title || '|' || url_1 END AS value FROM ({D.WIDE})"""

# Projections, filters and predicates.
ORACLE["p01_standardize_columns"] = f'WITH {CATALOG} SELECT "Supplier", "Serial_Number", "Product_Name" FROM catalog'
ORACLE["p05_extracted_columns_replaced"] = f"""SELECT 'East' AS "Supplier", p_partkey AS "Serial_Number",
  {weight('name')} AS "Weight_Quantity", {units('name')} AS "Units_Per_Carton", {packaging('name')} AS "Packaging_Type"
  FROM (SELECT p_partkey, {D.PACKED_NAME} AS name FROM part)"""
ORACLE["p07_lineage_and_stamps"] = """SELECT doc_id, '2025-01-31 08:00:00' AS local_stamp,
  '2025-01-31T08:00:00' AS utc_stamp, '2025-01-31T08:00:00.250000' AS utc_micros FROM documents"""
ORACLE["p08_normalize_key"] = "SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS serial, p_name AS title FROM part"
_STATUS = """CASE event_type WHEN 'view' THEN 'Available' WHEN 'click' THEN 'available' WHEN 'error' THEN 'AVAILABLE'
  ELSE 'Not Available' END"""
_FLAG = "CASE WHEN value < 5 THEN NULL WHEN value < 20 THEN 0 ELSE 1 END"
ORACLE["p09_pending"] = f"SELECT event_id, {_STATUS} AS status, {_FLAG} AS scraped FROM events WHERE NOT value >= 20"
ORACLE["p10_available_pending"] = f"""SELECT event_id, {_STATUS} AS status, {_FLAG} AS scraped FROM events
  WHERE value < 20 AND event_type IN ('view', 'click')"""
ORACLE["p12_drop_blank_keys"] = f"""SELECT "Product_ID", "Serial_Number" FROM ({D.MASTER}) WHERE coalesce(trim("Serial_Number"), '') <> ''"""
ORACLE["p13_sentinel_fill"] = "SELECT id, " + ", ".join(
    f"CASE WHEN url_{r}_title IS NULL OR url_{r}_title = '' THEN 'Not Available' ELSE url_{r}_title END AS title_{r}" for r in (2, 4, 5)
) + f" FROM ({D.WIDE})"

# Extraction.
_N = f"FROM (SELECT p_partkey, {D.PACKED_NAME} AS name FROM part)"
ORACLE["x01_weight_quantity"] = f"SELECT p_partkey, {weight('name')} AS weight {_N}"
ORACLE["x03_units_per_carton"] = f"SELECT p_partkey, {units('name')} AS units {_N}"
ORACLE["x04_weight_token"] = rf"""SELECT p_partkey, CASE WHEN regexp_matches(name, '(?i)\d\s?[KGLM]')
  THEN nullif(replace(upper(regexp_extract(name, '(?i)\d+(?:\.\d+)?\s?(?:KG|G|L|ML)')), ' ', ''), '') END AS weight {_N}"""
ORACLE["x05_units_early"] = f"SELECT p_partkey, {units('name', early=True)} AS units {_N}"
ORACLE["x06_packaging_type"] = f"SELECT p_partkey, {packaging('name')} AS packaging {_N}"
ORACLE["x07_packaging_from_unit"] = f"SELECT p_partkey, {UNIT_PACKAGING} AS packaging FROM part"
ORACLE["x08_collapse_spaces"] = r"SELECT doc_id, trim(regexp_replace(text, '[\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS text FROM documents"
ORACLE["x09_brand_and_title"] = """SELECT p_partkey, CASE WHEN p_size % 3 = 2 THEN p_brand || ' ' ELSE '' END ||
  CASE WHEN p_size % 5 > 0 THEN p_name ELSE 'Not Available' END AS title FROM part"""
_PATH = "regexp_replace(url, '^https?://[^/]*', '')"
ORACLE["x10_absolute_url"] = f"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Not Available' WHEN 1 THEN url
  ELSE CASE WHEN {_PATH} = '' THEN 'Not Available' ELSE 'https://shop.example.com' || {_PATH} END END AS url FROM pages"""
ORACLE["x11_drop_query"] = f"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Not Available' WHEN 1 THEN url
  ELSE CASE WHEN {_PATH} = '' THEN 'Not Available' WHEN {_PATH} LIKE '/%'
    THEN 'https://shop.example.com' || string_split({_PATH}, '?')[1] ELSE {_PATH} END END AS url FROM pages"""
ORACLE["x12_search_url"] = """SELECT p_partkey, 'https://shop.example.com/s?k=' ||
  replace(replace(p_brand, '#', '%23') || ' ~%2A%C3%A9%26%2B' || p_name, ' ', '+') AS url FROM part"""
ORACLE["x13_price_text"] = "SELECT p_partkey, 'AED ' || p_retailprice AS price FROM part"

# Reports.
ORACLE["a01_total_products"] = f"SELECT count(*) AS total_products FROM ({D.MASTER})"
ORACLE["a02_by_packaging"] = f'SELECT "Packaging_Type", count(*) AS count FROM ({D.MASTER}) GROUP BY 1'
ORACLE["a03_total_units"] = rf"""SELECT CAST(sum(CASE WHEN "Packaging_Type" = 'CTN' AND "Units_Per_Carton" NOT IN ('N/A', '', '0', 'NULL')
  THEN coalesce(TRY_CAST(regexp_extract("Units_Per_Carton", '^\s*([+-]?\d+)', 1) AS BIGINT), 0) ELSE 1 END) AS BIGINT) AS total_units
  FROM ({D.MASTER})"""
ORACLE["a04_duplicate_serials"] = f'SELECT "Serial_Number", count(*) AS count FROM ({D.MASTER}) GROUP BY 1 HAVING count(*) > 1'
ORACLE["a05_missing_serials"] = f"""SELECT count(*) AS missing_serials FROM ({D.MASTER})
  WHERE "Serial_Number" IS NULL OR trim("Serial_Number") = ''"""
ORACLE["a06_by_supplier"] = f'SELECT "Supplier", count(*) AS total_products FROM ({D.MASTER}) GROUP BY 1 ORDER BY 2 DESC, 1'
ORACLE["a07_in_several_catalogs"] = f"""SELECT "Serial_Number", count(DISTINCT "Supplier") AS supplier_count
  FROM ({D.MASTER}) GROUP BY 1 HAVING count(DISTINCT "Supplier") > 1"""
ORACLE["a08_only_in_one_catalog"] = f"""SELECT count(*) AS unique_products FROM (SELECT "Serial_Number" FROM ({D.MASTER})
  GROUP BY 1 HAVING count(DISTINCT "Supplier") = 1)"""

# Union, dedup, keys and state.
ORACLE["d01_dedup_keep_first"] = """SELECT p_name, p_brand, min(p_partkey) AS p_partkey, arg_min(p_type, p_partkey) AS p_type,
  arg_min(p_size, p_partkey) AS p_size FROM part GROUP BY 1, 2"""
ORACLE["d02_union_sources"] = f"""WITH {CATALOG} SELECT "Supplier", "Product_Name", "Weight_Quantity", "Units_Per_Carton",
  "Packaging_Type" FROM extracted"""
ORACLE["d03_skip_done"] = "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
_SIDES = "(SELECT user_id, ts, event_id, event_type, value, event_type NOT IN ('view', 'click') AS is_new FROM events)"
ORACLE["d04_upsert_last"] = f"""SELECT user_id, ts, event_id, event_type, value FROM {_SIDES}
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY is_new DESC, ts DESC, event_id DESC) = 1"""
ORACLE["d05_upsert_first"] = f"""SELECT user_id, ts, event_id, event_type, value FROM {_SIDES}
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY is_new, ts, event_id) = 1"""
ORACLE["d06_mark_processed"] = """SELECT doc_id, CAST(doc_id IN (SELECT doc_id FROM labels) AS INTEGER) AS scraped FROM documents"""
ORACLE["d07_evolve_schema"] = "SELECT doc_id, 0 AS scraped FROM documents"
ORACLE["d09_dense_ids"] = """SELECT o_orderkey, o_orderdate,
  'order_' || row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_id FROM orders"""
ORACLE["d10_failed_records"] = """SELECT doc_id FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)"""

# Matching. Scores come from token counts per pair, unnested and regrouped.
_SPLIT = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]{{2,}}')"
_SCORE = """CASE WHEN sum(a * b) > 0 THEN sum(a * b) / sqrt(
    CAST(sum(CASE WHEN b > 0 THEN a * a ELSE a * a * power(ln(1.5) + 1, 2) END) AS DOUBLE)
    * sum(CASE WHEN a > 0 THEN b * b ELSE b * b * power(ln(1.5) + 1, 2) END)) ELSE 0.0 END"""


def scores(pairs: str, keys: str, stop: list[str] = ()) -> str:
    """CTEs that end in ``scored(keys, similarity)`` from ``pairs(keys, a, b)``."""
    words = ", ".join(f"'{w}'" for w in stop) or "''"
    return f"""pairs AS ({pairs}),
words AS (
  SELECT {keys}, unnest({_SPLIT.format('a')}) AS word, 1 AS a, 0 AS b FROM pairs
  UNION ALL SELECT {keys}, unnest({_SPLIT.format('b')}), 0, 1 FROM pairs),
counts AS (SELECT {keys}, word, sum(a) AS a, sum(b) AS b FROM words WHERE word NOT IN ({words}) GROUP BY ALL),
found AS (SELECT {keys}, {_SCORE} AS similarity FROM counts GROUP BY {keys}),
scored AS (SELECT {', '.join('pairs.' + k.strip() for k in keys.split(','))}, coalesce(similarity, 0.0) AS similarity
  FROM pairs LEFT JOIN found USING ({keys}))"""


LONG = " UNION ALL ".join(
    f"SELECT id, {r} AS rank, url_{r} AS url, url_{r}_title AS title, trim(input_title) AS input_title FROM ({D.WIDE})" for r in range(1, 6)
)
TITLE_PAIRS = f"SELECT id, rank, url, input_title AS a, title AS b FROM ({LONG}) WHERE title <> ''"
SCORED = scores(TITLE_PAIRS, "id, rank, url")
BEST = """best AS (SELECT id, arg_max(url, (round(similarity, 9), -rank)) AS url, max(similarity) AS similarity FROM scored
  WHERE similarity > 0 GROUP BY id)"""
_WIDE_SCORES = ", ".join(
    f"max(CASE WHEN rank = {r} THEN round(similarity, 3) END) AS url_{r}_similarity" for r in range(1, 6)
)
_DECIDED = """CASE WHEN similarity >= 0.6 THEN url ELSE 'Not available everywhere' END AS matched_url,
  CASE WHEN similarity >= 0.6 THEN 'Available' ELSE 'Not Available' END AS status"""
ORACLE["p14_missing_candidate_skipped"] = f"SELECT id, rank FROM ({LONG}) WHERE title IS NOT NULL AND title <> ''"
ORACLE["t01_title_cosine"] = f"WITH {SCORED} SELECT id, rank, round(similarity, 3) AS similarity FROM scored"
ORACLE["t01_long_text_cosine"] = f"""WITH {scores('SELECT d.doc_id, d.text AS a, n.text AS b FROM documents d JOIN documents n ON n.doc_id = d.doc_id + 1', 'doc_id')}
  SELECT doc_id, round(similarity, 3) AS similarity FROM scored"""
ORACLE["t02_cosine_without_stop_words"] = f"""WITH {scores(TITLE_PAIRS, 'id, rank, url', STOP_WORDS)}
  SELECT w.id, {_WIDE_SCORES}, '{D.AS_OF}' AS processed_date FROM ({D.WIDE}) w LEFT JOIN scored USING (id) GROUP BY w.id"""
ORACLE["t03_wide_to_long"] = f"SELECT id, rank, url, title FROM ({LONG})"
ORACLE["t04_best_candidate"] = f"WITH {SCORED}, {BEST} SELECT id, url AS best_url, round(similarity, 3) AS best_similarity FROM best"
ORACLE["t05_decision"] = f"""WITH {SCORED}, {BEST} SELECT w.id, serial_number, trim(input_title) AS input_title, {_DECIDED}
  FROM ({D.WIDE}) w LEFT JOIN best USING (id)"""
ORACLE["t06_augmented_scores"] = f"""WITH {SCORED}, {BEST}, wide AS (SELECT id, {_WIDE_SCORES} FROM scored GROUP BY id)
  SELECT w.id, url_1_similarity, url_2_similarity, url_3_similarity, url_4_similarity, url_5_similarity,
    round(coalesce(similarity, 0.0), 3) AS best_similarity, {_DECIDED}
  FROM ({D.WIDE}) w LEFT JOIN wide USING (id) LEFT JOIN best USING (id)"""
ORACLE["s06_write_augmented"] = ORACLE["t06_augmented_scores"]
ORACLE["t07_scores_to_wide"] = f"WITH {SCORED} SELECT id, {_WIDE_SCORES} FROM scored GROUP BY id"
ORACLE["a09_match_coverage"] = f"""WITH {SCORED}, {BEST}
  SELECT CASE WHEN similarity >= 0.6 THEN 'Matched' ELSE 'Not Matched' END AS "Match_Status", count(*) AS "Count"
  FROM ({D.WIDE}) w LEFT JOIN best USING (id) GROUP BY 1"""
ORACLE["t08_top_five"] = """SELECT user_id, rank, event_id, title FROM (SELECT user_id, event_id, event_type AS title,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS rank FROM events) WHERE rank <= 5"""
_SLOT = lambda r, c: f"coalesce(nullif(max(CASE WHEN n = {r} THEN {c} END), ''), 'Not Available')"
ORACLE["t09_pad_to_five"] = "SELECT conv_id AS id, " + ", ".join(
    f"{_SLOT(r, 'role')} AS url_{r}, {_SLOT(r, 'text')} AS url_{r}_title" for r in range(1, 6)
) + " FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) GROUP BY conv_id"


def brute_force(records: str, items: str, threshold: float) -> str:
    """Every pair of distinct token bags that share a token, scored; then the top five items."""
    bag = "array_to_string(list_sort(" + _SPLIT.format("title") + "), ' ')"
    return f"""rec AS (SELECT *, {bag} AS bag FROM ({records})), item AS (SELECT *, {bag} AS bag FROM ({items})),
rec_words AS (SELECT bag, word, count(*) AS n FROM (SELECT bag, unnest(string_split(bag, ' ')) AS word
  FROM (SELECT DISTINCT bag FROM rec WHERE bag <> '')) GROUP BY ALL),
item_words AS (SELECT bag, word, count(*) AS n FROM (SELECT bag, unnest(string_split(bag, ' ')) AS word
  FROM (SELECT DISTINCT bag FROM item WHERE bag <> '')) GROUP BY ALL),
rec_size AS (SELECT bag, sum(n * n) AS size FROM rec_words GROUP BY bag),
item_size AS (SELECT bag, sum(n * n) AS size FROM item_words GROUP BY bag),
shared AS (SELECT r.bag AS rec_bag, i.bag AS item_bag, sum(r.n * i.n) AS dot, sum(r.n * r.n) AS r2, sum(i.n * i.n) AS i2
  FROM rec_words r JOIN item_words i USING (word) GROUP BY ALL),
close AS (SELECT rec_bag, item_bag, dot / (sqrt(r2 + (rs.size - r2) * power(ln(1.5) + 1, 2))
    * sqrt(i2 + (si.size - i2) * power(ln(1.5) + 1, 2))) AS similarity
  FROM shared JOIN rec_size rs ON rs.bag = rec_bag JOIN item_size si ON si.bag = item_bag),
ranked AS (SELECT rec_bag, key, url, title, similarity,
    CAST(row_number() OVER (PARTITION BY rec_bag ORDER BY round(similarity, 9) DESC, key) AS INTEGER) AS rank
  FROM close JOIN item ON item.bag = item_bag WHERE similarity >= {threshold}),
retrieved AS (SELECT rec.id, rank, key, url, ranked.title, similarity FROM rec JOIN ranked ON rec.bag = rec_bag WHERE rank <= 5)"""


_RECORDS = f"SELECT id, serial_number, input_title, input_title AS title FROM ({D.RECORD_TITLES})"
ORACLE["t10_retrieve_candidates"] = f"""WITH {brute_force(_RECORDS, D.ITEM_TITLES, 0.6)}
  SELECT id, rank, key, url, title, round(similarity, 3) AS similarity FROM retrieved"""
ORACLE["t10_templated"] = f"""WITH {brute_force(D.TEMPLATED_RECORDS, D.TEMPLATED_ITEMS, 0.6)}
  SELECT id, rank, key, url, title, round(similarity, 3) AS similarity FROM retrieved"""
ORACLE["t10_long_documents"] = f"""WITH {brute_force(D.LONG_RECORDS, D.LONG_ITEMS, 0.4)}
  SELECT id, rank, key, url, round(similarity, 3) AS similarity FROM retrieved"""
_REPEATED = f"SELECT serial_number AS id, input_title AS title FROM ({D.REPEATED_RECORDS})"
ORACLE["t11_repeated_ids"] = f"""WITH {brute_force(_REPEATED, D.ITEM_TITLES, 0.6)}
  SELECT r.id, serial_number, input_title, CASE WHEN b.id IS NULL THEN 'Not available everywhere' ELSE b.url END AS matched_url,
    CASE WHEN b.id IS NULL THEN 'Not Available' ELSE 'Available' END AS status
  FROM ({D.REPEATED_RECORDS}) r LEFT JOIN (SELECT id, url FROM retrieved WHERE rank = 1) b ON r.serial_number = b.id"""
ORACLE["t11_match_summary"] = f"""WITH {brute_force(_RECORDS, D.ITEM_TITLES, 0.6)}
  SELECT r.id, serial_number, input_title, CASE WHEN b.id IS NULL THEN 'Not available everywhere' ELSE b.url END AS matched_url,
    CASE WHEN b.id IS NULL THEN 'Not Available' ELSE 'Available' END AS status
  FROM ({D.RECORD_TITLES}) r LEFT JOIN (SELECT id, url FROM retrieved WHERE rank = 1) b ON r.id = b.id"""

# Page attributes: the markup of the derived pages is known, so plain regexes find each element.
_TAG = r"""<[/!?a-zA-Z](?:[^>"''=]|=\s*"[^"]*"|=\s*''[^'']*''|[="''])*>"""
_HIDE = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_LIVE = f"regexp_replace(html, '{_HIDE}', '<!>', 'g')"
_BLANKS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(160)"


def decode(x: str) -> str:
    for name, char in [("quot", '"'), ("nbsp", "\xa0"), ("copy", "©"), ("middot", "·"), ("amp", "&")]:
        x = f"replace({x}, '&{name};', '{char}')"
    return x


def strings(markup: str, sep: str) -> str:
    pieces = f"string_split({decode(f'''regexp_replace({markup}, '{_TAG}', chr(1), 'g')''')}, chr(1))"
    trimmed = f"list_transform({pieces}, lambda s: trim(s, {_BLANKS}))"
    return f"array_to_string(list_filter({trimmed}, lambda s: s <> ''), '{sep}')"


def element(pattern: str) -> str:
    """Inner text of a pattern's group, null when the element is not there."""
    return f"CASE WHEN regexp_matches(live, '(?s){pattern}') THEN {strings(f'''regexp_extract(live, '(?s){pattern}', 1)''', '')} END"


def items(container: str) -> str:
    inside = f"regexp_extract(live, '(?s){container}', 1)"
    texts = f"list_transform(regexp_extract_all({inside}, '(?s)<li>(.*?)</li>', 1), lambda x: {strings('x', ' ')})"
    return f"nullif(array_to_string(list_filter({texts}, lambda s: s <> ''), ' | '), '')"


_LINES = f"string_split({decode(f'''regexp_replace(live, '{_TAG}', chr(10), 'g')''')}, chr(10))"


def line_value(key: str) -> str:
    usable = rf"list_filter(lines, lambda s: contains(lower(s), '{key}') AND (contains(s, ':') OR regexp_matches(s, '[^\s]\s+[^\s]')))"
    first = f"{usable}[1]"
    return rf"""CASE WHEN len({usable}) > 0 THEN CASE WHEN contains({first}, ':')
      THEN trim(substr({first}, strpos({first}, ':') + 1)) ELSE regexp_extract(trim({first}), '[^\s]+$') END END"""


PAGE_FIELDS = rf"""live AS (SELECT page_id, url, {_LIVE} AS live FROM ({D.PRODUCT_PAGES})),
lines AS (SELECT *, {_LINES} AS lines, lower({strings('live', ' ')}) AS seen FROM live),
fields AS (SELECT page_id, url, seen LIKE '%robot check%' OR seen LIKE '%press and hold%' OR seen LIKE '%enter the characters you see%' AS unusable,
  nullif(trim(regexp_replace({element('<span id="productTitle"[^>]*>(.*?)</span>')}, '[\s\x{{a0}}]+', ' ', 'g')), '') AS main_title,
  nullif(trim(regexp_replace({element('<h1[^>]*>(.*?)</h1>')}, '[\s\x{{a0}}]+', ' ', 'g')), '') AS h1_title,
  regexp_matches(live, 'id="productTitle"') AS has_title,
  coalesce(nullif({element('<span id="priceblock_ourprice">(.*?)</span>')}, ''),
    nullif({element('<span id="priceblock_dealprice">(.*?)</span>')}, ''),
    nullif({element('<span class="a-price b"><span class="a-offscreen">(.*?)</span>')}, ''),
    nullif({element('<span class="a-offscreen">(.*?)</span>')}, '')) AS page_price,
  coalesce(nullif(regexp_extract(live, 'data-old-hires="([^"]*)"', 1), ''),
    nullif(regexp_extract(live, '<img alt="[^"]*" src="([^"]*)"', 1), ''),
    nullif(regexp_extract(live, '<meta property="og:image" content="([^"]*)"', 1), '')) AS page_image,
  coalesce({items('<div id="feature-bullets">(.*?)</div></div>')}, {items('<div id="productDetails_feature_div">(.*?)</div>')},
    {items('<ul class="a-unordered-list[^>]*>(.*?)</ul>')}) AS page_description,
  nullif(coalesce(CASE WHEN live LIKE '%detailBullets_sections1%' THEN trim(regexp_extract(live, '<th> UPC code </th><td>([^<]*)</td>', 1)) END,
    {line_value('ean')}, {line_value('upc')}, {line_value('barcode')}, {line_value('asin')},
    nullif(regexp_extract(array_to_string(lines, chr(10)), '(?:^|[^\p{{L}}\p{{N}}_])(\d{{8,14}})(?:$|[^\p{{L}}\p{{N}}_])', 1), '')), '') AS page_barcode
FROM lines)"""

ORACLE["h02_title"] = f"WITH {PAGE_FIELDS} SELECT page_id, CASE WHEN has_title THEN main_title ELSE h1_title END AS page_title FROM fields"
for _key, _field in [("h03_price", "page_price"), ("h04_image", "page_image"), ("h05_description", "page_description"), ("h06_barcode", "page_barcode")]:
    ORACLE[_key] = f"WITH {PAGE_FIELDS} SELECT page_id, {_field} FROM fields"
ORACLE["h07_visible_text"] = f"SELECT page_id, {strings('live', ' ')} AS text FROM (SELECT page_id, {_LIVE} AS live FROM pages)"
ORACLE["h08_unusable_page"] = f"""WITH {PAGE_FIELDS} SELECT page_id, unusable, seen LIKE '%robot check%' OR seen LIKE '%captcha%'
  OR seen LIKE '%enter the characters you see below%' OR seen LIKE '%we have detected unusual traffic%' OR seen LIKE '%are you a human%'
  AS unusable_search FROM fields JOIN (SELECT page_id, seen FROM lines) USING (page_id)"""

_ROUTED = f"""{PAGE_FIELDS}, matches AS ({D.PAGE_MATCHES}),
routed AS (SELECT m.*, f.*, CASE WHEN matched_url = '' OR contains(status, 'Not Available') THEN 'no match'
    WHEN f.page_id IS NULL THEN 'missing page' WHEN unusable THEN 'unusable page' ELSE 'parsed' END AS outcome
  FROM matches m LEFT JOIN fields f ON f.url = m.matched_url)"""
_OUT = lambda c: f"CASE WHEN outcome = 'parsed' THEN coalesce({c}, 'Not Available') ELSE 'Not Available' END"
_SCRAPED = f"""{_ROUTED}, scraped AS (SELECT CAST(id AS BIGINT) AS "Scrape_ID", serial_number AS "Serial_Number",
  {_OUT('main_title')} AS "Product_Name", input_title AS "Matched_Product_Name",
  CASE WHEN outcome = 'unusable page' THEN 'Blocked by anti-bot' ELSE {_OUT('page_description')} END AS "Description",
  {_OUT('page_price')} AS "Price_AED", {_OUT('page_image')} AS "Image_URL", {_OUT('page_barcode')} AS "Barcode",
  CASE WHEN matched_url = '' THEN 'Not Available' ELSE matched_url END AS "Source_URL",
  'https://shop.example.com/' AS "Source_Website", '2025-01-31T08:00:00' AS "Last_Updated", outcome FROM routed)"""
ORACLE["h09_scraped_products"] = f"WITH {_SCRAPED} SELECT * EXCLUDE (outcome) FROM scraped"
ORACLE["e3_resumed_batches"] = ORACLE["h09_scraped_products"]
ORACLE["s07_append_results"] = f'WITH {_SCRAPED} SELECT "Scrape_ID", "Product_Name", "Price_AED" FROM scraped'
ORACLE["a10_barcode_coverage"] = f"""WITH {_SCRAPED} SELECT CASE WHEN "Barcode" = 'Not Available' THEN 'Missing' ELSE 'Available' END AS "Barcode_Status",
  count(*) AS "Count" FROM scraped WHERE outcome = 'parsed' GROUP BY 1"""
ORACLE["a11_image_coverage"] = f"""WITH {_SCRAPED} SELECT 'Available' AS "Image_Status", count(*) AS "Count" FROM scraped
  WHERE outcome = 'parsed' AND "Image_URL" <> 'Not Available'"""
ORACLE["h10_all_empty_check"] = f"""WITH {_ROUTED} SELECT CASE WHEN outcome = 'parsed' AND main_title IS NULL AND page_description IS NULL
  AND page_price IS NULL THEN 'empty page' ELSE outcome END AS outcome, count(*) AS n FROM routed GROUP BY 1"""
ORACLE["d08_downgrade_failed"] = f"""WITH {_ROUTED} SELECT id, CASE WHEN outcome IN ('missing page', 'unusable page') THEN 'Not Available' ELSE status END AS status,
  CAST(outcome <> 'no match' AS INTEGER) AS scraped FROM routed"""
ORACLE["s09_read_pending"] = f"SELECT * FROM ({D.PAGE_MATCHES}) WHERE id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)"
ORACLE["h11_titles_from_pages"] = f"""SELECT m.id, m.matched_url AS url,
  CASE WHEN p.page_id % 3 > 0 THEN 'Page ' || p.page_id ELSE 'Not Available' END AS title
  FROM ({D.PAGE_MATCHES}) m LEFT JOIN pages p ON p.url = m.matched_url"""

_RESULTS = "SELECT page_id, CAST(page_id AS VARCHAR) AS id, unnest(range(1, CAST(page_id % 8 AS BIGINT) + 1)) AS i FROM pages"
_BRAND = "CASE WHEN i % 2 = 1 THEN 'Brand' || i || ' ' ELSE '' END"
_PRODUCT = "CASE WHEN i % 5 = 4 THEN 'Not Available' ELSE 'Product' || i || 'of ' || page_id END"
ORACLE["h01_result_list"] = f"""SELECT id, CAST(i - 1 AS INTEGER) AS position, CASE WHEN i % 4 = 3 THEN 'Not Available'
  ELSE 'https://shop.example.com/dp/' || page_id || '/' || i || '?ref=' || i || '&x=1' END AS url, {_BRAND} || {_PRODUCT} AS title FROM ({_RESULTS})"""
ORACLE["h01_nested_slots"] = ORACLE["h01_result_list"]
ORACLE["h01_result_list_early"] = f"""SELECT id, CAST(i - 1 AS INTEGER) AS position, CASE WHEN i % 4 = 3 THEN 'Not Available'
  ELSE 'https://shop.example.com/dp/' || page_id || '/' || i END AS url, {_BRAND} || {_PRODUCT} AS title FROM ({_RESULTS})"""
_E2_TITLE = "'Brand1 Product 1 of ' || CASE WHEN page_id % 3 = 0 THEN '' ELSE CAST(page_id AS VARCHAR) END"
_E2_PAIRS = f"""SELECT id, i AS rank, CASE WHEN i % 4 = 3 THEN 'Not Available' ELSE 'https://shop.example.com/dp/' || page_id || '/' || i
  || '?ref=' || i || '&x=1' END AS url, {_E2_TITLE} AS a, {_BRAND} || {_PRODUCT} AS b FROM ({_RESULTS}) WHERE i <= 5"""
ORACLE["e2_results_to_matches"] = f"""WITH {scores(_E2_PAIRS, 'id, rank, url')}, {BEST},
  records AS (SELECT CAST(page_id AS VARCHAR) AS id, 'S' || page_id AS serial_number, {_E2_TITLE} AS input_title FROM pages)
  SELECT r.id, serial_number, trim(input_title) AS input_title, {_DECIDED} FROM records r LEFT JOIN best USING (id)"""
ORACLE["e2_resumed"] = f"SELECT * REPLACE ('S' || id AS id) FROM ({ORACLE['e2_results_to_matches']})"

# Order, preview, end to end.
ORACLE["l02_preview"] = f"WITH {CATALOG} {CLEAN} FROM clean ORDER BY source, p_partkey LIMIT 10"
ORACLE["e1_catalog_to_report"] = f"""WITH {CATALOG} SELECT "Packaging_Type", "Supplier", count(*) AS rows,
  CAST(sum(CASE WHEN "Packaging_Type" = 'CTN' AND "Units_Per_Carton" <> 0 THEN "Units_Per_Carton" ELSE 1 END) AS BIGINT) AS units,
  CAST(0 AS BIGINT) AS missing FROM clean GROUP BY 1, 2"""


def report_row(report: tuple[str, str], table: str) -> str:
    name, query = report
    columns = {
        "a01": ["total_products"], "a02": ["Packaging_Type", "count"], "a03": ["total_units"], "a04": ["Serial_Number", "count"],
        "a05": ["missing_serials"], "a06": ["Supplier", "total_products"], "a07": ["Serial_Number", "supplier_count"],
        "a08": ["unique_products"],
    }[table[:3]]
    row = "{" + ", ".join(f"'{c}': \"{c}\"" for c in columns) + "}"
    return f"""SELECT '{name}' AS "Query_Description", '{query.replace("'", "''")}' AS "Query", CAST(to_json({row}) AS VARCHAR) AS "Result",
      '{D.AS_OF}' AS "Generated_At" FROM ({ORACLE[table]})"""


def report_sql() -> str:
    tables = [key for key in ORACLE if key[:3] in [f"a{n:02}" for n in range(1, 9)]]
    return " UNION ALL ".join(f"({report_row(report, table)})" for report, table in zip(REPORTS.items(), tables))


ORACLE["a12_report"] = ORACLE["s08_write_report"] = report_sql()
ORACLE["e3_text_ids"] = f"""WITH {_SCRAPED} SELECT CASE WHEN "Scrape_ID" % 3 = 0 THEN 'A-' || "Scrape_ID" WHEN "Scrape_ID" % 3 = 1 THEN '00' || "Scrape_ID"
  ELSE CAST("Scrape_ID" AS VARCHAR) END AS record_id, CAST(1 AS BIGINT) AS n, "Product_Name", CASE WHEN "Scrape_ID" % 3 <> 0 THEN "Scrape_ID" END AS "Scrape_ID" FROM scraped"""
