"""DuckDB SQL for the queries of ``queries.py``, written apart from the operators."""

from __future__ import annotations

from blotterlake.catalog.fixture import BEATS_SQL, CROSSWALK_SQL, INCIDENTS_SQL
from blotterlake.config import CHARGE_TYPES, DROP_COLUMNS, REDACT_COLUMNS, SEVERITY_ORDER
from blotterlake.functions.stem import (
    ADJECTIVE_SUFFIXES, DERIVED_SUFFIXES, DROPPED_SUFFIXES, REGION_PREFIXES, SPECIAL_WORDS, STOP_AFTER_PLURAL,
)
from blotterlake.functions.text import LETTER_PAIRS, MARKED_LETTERS, PLAIN_LETTERS, STOP_WORDS

SLOTS = (1, 2, 3, 4)


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# ---- scalar expressions -------------------------------------------------------------------


def severity(col: str) -> str:
    arms = " ".join(f"WHEN {text(c)} THEN {i}" for i, c in enumerate(SEVERITY_ORDER))
    return f"CASE {col} {arms} ELSE -1 END"


def charge_type(code: str) -> str:
    return (
        f"CASE WHEN {code} BETWEEN 8 AND 13 THEN 'Felony' WHEN {code} IN (5, 6, 7) THEN "
        f"'Misdemeanor' WHEN {code} BETWEEN 1 AND 4 THEN 'Petty or Other' WHEN {code} = 0 THEN "
        "'None' ELSE 'Not Specified' END"
    )


def quarters(ts: str) -> str:
    """Quarter hours since the epoch, ties to even."""
    return f"cast(round_even(epoch_us({ts}) / 900000000.0, 0) AS bigint)"


def key_text(col: str, width: int) -> str:
    whole = f"cast(trunc(coalesce({col}, 0)) AS bigint)"
    return f"CASE WHEN {whole} < {10 ** (width - 1)} THEN lpad(cast({whole} AS varchar), {width}, '0') ELSE cast({whole} AS varchar) END"


def clean(col: str) -> str:
    out = f"regexp_replace(lower({col}), '\\p{{M}}+', '', 'g')"
    for letter, pair in LETTER_PAIRS.items():
        out = f"replace({out}, {text(letter)}, {text(pair)})"
    out = f"translate({out}, {text(MARKED_LETTERS)}, {text(PLAIN_LETTERS)})"
    out = f"regexp_replace({out}, '\\b\\d+\\b', ' ', 'g')"
    word = "[\\p{L}\\p{N}_]"
    parts = f"regexp_extract_all({out}, '{word}+(?:-{word}+)*|\\s+|[^\\p{{L}}\\p{{N}}_\\s]')"
    stops = ", ".join(text(w) for w in STOP_WORDS)
    out = f"array_to_string(list_filter({parts}, lambda w: w NOT IN ({stops})), '')"
    out = f"regexp_replace({out}, '[[:punct:]]+', ' ', 'g')"
    return f"trim(regexp_replace({out}, '[\\s\\x{{A0}}]+', ' ', 'g'))"


def _suffix_case(suffixes, arm) -> str:
    """CASE over suffixes, the longest first; ``arm`` gives the result of one."""
    arms = " ".join(f"WHEN ends_with(w, {text(s)}) THEN {arm(s)}" for s in sorted(suffixes, key=len, reverse=True))
    return f"CASE {arms} ELSE w END"


def _cut(suffix: str) -> str:
    return f"left(w, length(w) - {len(suffix)})"


def stem_tables(source: str) -> dict[str, str]:
    """stems(word, stem) of the distinct words that ``source`` selects: the published steps, one table each.

    r1 and r2 are the numbers of letters before the two regions; ``done`` words change no more.
    """
    vowel_run, short_end = "'^.*?[aeiouy][^aeiouy]'", "'([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$'"
    prefix = " ".join(f"WHEN starts_with(w, {text(p)}) THEN {len(p)}" for p in REGION_PREFIXES)
    special = " ".join(f"WHEN {text(a)} THEN {text(b)}" for a, b in SPECIAL_WORDS.items())

    def derived(s: str) -> str:
        before = {"ogi": " AND right(b, 1) = 'l'", "li": " AND right(b, 1) IN ('c','d','e','g','h','k','m','n','r','t')"}
        return f"CASE WHEN length({_cut(s)}) >= r1{before.get(s, '').replace('b,', _cut(s) + ',')} THEN {_cut(s)} || {text(DERIVED_SUFFIXES[s])} ELSE w END"

    def adjective(s: str) -> str:
        region = "r2" if s == "ative" else "r1"
        return f"CASE WHEN length({_cut(s)}) >= {region} THEN {_cut(s)} || {text(ADJECTIVE_SUFFIXES[s])} ELSE w END"

    def dropped(s: str) -> str:
        before = f" AND right({_cut(s)}, 1) IN ('s', 't')" if s == "ion" else ""
        return f"CASE WHEN length({_cut(s)}) >= r2{before} THEN {_cut(s)} ELSE w END"

    def past(s: str) -> str:
        if s.startswith("eed"):
            return f"CASE WHEN length({_cut(s)}) >= r1 THEN {_cut(s)} || 'ee' ELSE w END"
        base = _cut(s)
        return f"""CASE WHEN NOT regexp_matches({base}, '[aeiouy]') THEN w
          WHEN regexp_matches({base}, '(at|bl|iz)$') THEN {base} || 'e'
          WHEN regexp_matches({base}, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN left({base}, length({base}) - 1)
          WHEN regexp_matches({base}, {short_end}) AND length({base}) <= r1 THEN {base} || 'e' ELSE {base} END"""

    step = lambda before, expression: f"SELECT word, r1, r2, done, CASE WHEN done THEN w ELSE {expression} END AS w FROM {before}"
    stop = ", ".join(text(x) for x in sorted(STOP_AFTER_PLURAL))
    return {
        "stem_marked": f"""
SELECT word, length(word) <= 2 OR word IN ({', '.join(map(text, SPECIAL_WORDS))}) AS done,
       CASE word {special} ELSE CASE WHEN length(word) <= 2 THEN word ELSE array_to_string(list_transform(range(1, length(word) + 1),
         lambda i: CASE WHEN word[i] = 'y' AND (i = 1 OR word[i - 1] IN ('a','e','i','o','u','y')) THEN 'Y' ELSE word[i] END), '') END END AS w
FROM (SELECT DISTINCT word FROM ({source}) s) d""",
        "stem_first": f"""
SELECT *, CASE {prefix} ELSE CASE WHEN regexp_matches(w, {vowel_run}) THEN length(regexp_extract(w, {vowel_run})) ELSE length(w) END END AS r1
FROM stem_marked""",
        "stem_regions": f"""
SELECT *, CASE WHEN regexp_matches(substr(w, r1 + 1), {vowel_run}) THEN r1 + length(regexp_extract(substr(w, r1 + 1), {vowel_run})) ELSE length(w) END AS r2
FROM stem_first""",
        "stem_plural": step("stem_regions", """CASE WHEN ends_with(w, 'sses') THEN left(w, length(w) - 2)
          WHEN ends_with(w, 'ied') OR ends_with(w, 'ies') THEN left(w, length(w) - CASE WHEN length(w) > 4 THEN 2 ELSE 1 END)
          WHEN ends_with(w, 's') AND NOT ends_with(w, 'us') AND NOT ends_with(w, 'ss') AND regexp_matches(left(w, length(w) - 2), '[aeiouy]')
          THEN left(w, length(w) - 1) ELSE w END"""),
        "stem_stopped": f"SELECT word, r1, r2, done OR w IN ({stop}) AS done, w FROM stem_plural",
        "stem_past": step("stem_stopped", _suffix_case(("eed", "eedly", "ed", "edly", "ing", "ingly"), past)),
        "stem_y": step("stem_past", "CASE WHEN regexp_matches(w, '.[^aeiouy][yY]$') THEN left(w, length(w) - 1) || 'i' ELSE w END"),
        "stem_derived": step("stem_y", _suffix_case(DERIVED_SUFFIXES, derived)),
        "stem_adjective": step("stem_derived", _suffix_case(ADJECTIVE_SUFFIXES, adjective)),
        "stem_dropped": step("stem_adjective", _suffix_case(DROPPED_SUFFIXES, dropped)),
        "stem_final": step("stem_dropped", f"""CASE WHEN ends_with(w, 'e') AND (length(w) - 1 >= r2
            OR (length(w) - 1 >= r1 AND NOT regexp_matches(left(w, length(w) - 1), {short_end}))) THEN left(w, length(w) - 1)
          WHEN ends_with(w, 'll') AND length(w) - 1 >= r2 THEN left(w, length(w) - 1) ELSE w END"""),
        "stems": "SELECT word, replace(w, 'Y', 'y') AS stem FROM stem_final",
    }


def stemmed(key: str, source: str) -> str:
    """key and text with every word of ``source``'s text replaced by its stem."""
    return f"""SELECT {key}, CASE WHEN any_value(text) IS NOT NULL THEN coalesce(string_agg(stem, ' ' ORDER BY place), '') END AS text
FROM (SELECT {key}, text, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS place FROM {source}
      UNION ALL SELECT {key}, text, NULL, 0 FROM {source}) w LEFT JOIN stems USING (word) GROUP BY {key}"""


def words(col: str) -> str:
    return f"regexp_extract_all(lower({col}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"


def holdout(key: str) -> str:
    return f"(('0x' || substr(md5(cast({key} AS varchar) || '|0'), 1, 8))::bigint % 10)"


# ---- common tables ------------------------------------------------------------------------

_DATE = {
    "arrest_year": "year(arrest_date)::int", "arrest_month": "month(arrest_date)::int",
    "arrest_day": "day(arrest_date)::int", "arrest_hour": "hour(arrest_date)::int",
}
_TIME = {
    "arrest_minute": f"({quarters('arrest_date')} % 4) * 0.25::double",
    "arrest_time": f"hour(arrest_date) + ({quarters('arrest_date')} % 4) * 0.25::double",
}
DROPPED = ", ".join((*REDACT_COLUMNS, *DROP_COLUMNS))

PREPARED = f"""
SELECT i.* EXCLUDE ({DROPPED}, district, beat, received_in_lockup, released_from_lockup, arrest_date),
       {', '.join(f'{e} AS {c}' for c, e in {**_DATE, **_TIME}.items())},
       {', '.join(f'{severity(f"charge_{s}_class")} AS charge_{s}_class_cat_code' for s in SLOTS)},
       cast(cast(coalesce(i.district, 0) AS bigint) AS varchar) AS district,
       k.beat AS beat, b.unit AS unit
FROM incidents i JOIN (SELECT arrest_id AS kid, {key_text('beat', 4)} AS beat FROM incidents) k
  ON k.kid = i.arrest_id LEFT JOIN beats b ON b.beat = k.beat"""

FLAGGED = f"""
SELECT p.*, x.police_related AS lead_charge_police_related,
       p.charge_1_class_cat_code AS lead_charge_code,
       {charge_type('p.charge_1_class_cat_code')} AS lead_charge_code_type
FROM prepared p LEFT JOIN (SELECT * FROM xw WHERE description IS NOT NULL) x
  ON x.description = p.charge_1_description"""

LONG = " UNION ALL ".join(
    f"SELECT arrest_id, {s} AS slot, charge_{s}_description AS description FROM incidents "
    f"WHERE charge_{s}_description IS NOT NULL"
    for s in SLOTS
)

DESCRIPTIONS = f"""
SELECT description, {', '.join(f'count(*) FILTER (slot = {s}) AS n_slot_{s}' for s in SLOTS)},
       count(*) FILTER (slot = 1 AND {holdout('arrest_id')} < 7) AS n_train,
       count(*) FILTER (slot = 1 AND {holdout('arrest_id')} >= 7) AS n_test
FROM long GROUP BY description"""

# DuckDB's own distance lets a swap span other edits and so is never above the alignment distance:
# it picks the pairs worth computing, row by row of the distance table.
FUZZY = """
WITH RECURSIVE near AS (
  SELECT d.description AS text, x.description AS key
  FROM (SELECT description FROM descriptions WHERE description NOT IN
          (SELECT description FROM xw WHERE description IS NOT NULL)) d
  JOIN (SELECT description FROM xw WHERE description IS NOT NULL) x
    ON abs(length(d.description) - length(x.description)) <= 4
  WHERE damerau_levenshtein(d.description, x.description) <= 4),
osa AS (
  SELECT text, key, 0 AS i, range(0, length(key) + 1) AS row, cast(NULL AS bigint[]) AS above FROM near
  UNION ALL
  SELECT text, key, i + 1,
         list_reduce(range(1, length(key) + 1), lambda acc, j: list_append(acc, least(
           row[j + 1] + 1, acc[j] + 1, row[j] + (text[i + 1] <> key[j])::int,
           CASE WHEN i > 0 AND j > 1 AND text[i + 1] = key[j - 1] AND text[i] = key[j]
                THEN above[j - 1] + 1 ELSE 1000000 END)), [cast(i + 1 AS bigint)]),
         row
  FROM osa WHERE i < length(text)),
ranked AS (
  SELECT text, key, cast(row[length(key) + 1] AS int) AS distance,
         row_number() OVER (PARTITION BY text ORDER BY row[length(key) + 1], key) AS place
  FROM osa WHERE i = length(text))
SELECT text, key, distance FROM ranked WHERE place = 1 AND distance <= 4"""

RULED = """
SELECT d.*, coalesce(x.micro_category, f.micro_category,
                     CASE WHEN d.description LIKE 'CTA - %' THEN 'Nuisance' END) AS micro,
       coalesce(x.police_related, f.police_related) AS police,
       CASE WHEN x.micro_category IS NOT NULL THEN 'direct' WHEN f.micro_category IS NOT NULL
            THEN 'fuzzy' WHEN d.description LIKE 'CTA - %' THEN 'rule' END AS micro_method,
       CASE WHEN x.police_related IS NOT NULL THEN 'direct' WHEN f.police_related IS NOT NULL
            THEN 'fuzzy' END AS police_method
FROM descriptions d LEFT JOIN xw x ON x.description = d.description
LEFT JOIN fuzzy m ON m.text = d.description LEFT JOIN xw f ON f.description = m.key"""

MACROS = "SELECT micro_category AS micro, any_value(macro_category) AS macro FROM xw GROUP BY 1"


def naive_bayes(train: str, score: str) -> dict[str, str]:
    """Weights of every (label, word), in whole parts of 1e-9, and the best label of every row to score.

    ``train`` gives (text, label, n), ``score`` gives (id, text).
    """
    return {
        "nb_train": train,
        "nb_words": f"SELECT label, n, unnest({words('text')}) AS word FROM nb_train",
        "nb_pairs": "SELECT label, word, sum(n) AS n FROM nb_words GROUP BY label, word",
        "nb_grid": """
SELECT l.label, w.word, w.n AS n_all, coalesce(p.n, 0) AS n, p.n IS NOT NULL AS seen
FROM (SELECT DISTINCT label FROM nb_train) l
CROSS JOIN (SELECT word, sum(n) AS n FROM nb_pairs GROUP BY word) w
LEFT JOIN nb_pairs p ON p.label = l.label AND p.word = w.word""",
        "nb_weights": """
SELECT label, word, seen, (round(-ln(n_all + 1) * 1e9)::bigint + round((ln(n_all + 1) - ln(n_all - n + 1)) * 1e9)::bigint
       + round(ln(sum(n_all - n + 1) OVER (PARTITION BY label)) * 1e9)::bigint) AS units, units / 1e9 AS weight
FROM nb_grid""",
        "nb_score_rows": score,
        "nb_scores": f"""
SELECT s.id, w.label, sum(w.units) AS score
FROM (SELECT id, unnest({words('text')}) AS word FROM nb_score_rows) s
JOIN nb_weights w ON w.word = s.word GROUP BY s.id, w.label""",
        "nb_best": """
SELECT r.id, coalesce(b.label, (SELECT min(label) FROM nb_train)) AS prediction,
       coalesce(b.score, 0) / 1e9 AS score
FROM nb_score_rows r LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, label) AS place FROM nb_scores
) b ON b.id = r.id AND b.place = 1""",
    }


CTES = {
    "incidents": INCIDENTS_SQL,
    "xw": CROSSWALK_SQL,
    "beats": BEATS_SQL,
    "prepared": PREPARED,
    "flagged": FLAGGED,
    "long": LONG,
    "descriptions": DESCRIPTIONS,
    "fuzzy": FUZZY,
    "ruled": RULED,
    "ruled_text": f"SELECT *, {clean('description')} AS text FROM ruled",
    "macros": MACROS,
}
NEEDS = {
    "prepared": ("incidents", "beats"),
    "flagged": ("prepared", "xw"),
    "long": ("incidents",),
    "descriptions": ("long",),
    "fuzzy": ("descriptions", "xw"),
    "ruled": ("descriptions", "fuzzy", "xw"),
    "ruled_text": ("ruled",),
    "macros": ("xw",),
}


def with_tables(select: str, *names: str, more: dict[str, str] | None = None) -> str:
    """Put the named common tables, and those they need, before a SELECT."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, ()):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = {name: CTES[name] for name in order} | (more or {})
    body = ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in parts.items())
    return f"WITH {body}\n{select}"


# ---- oracles ------------------------------------------------------------------------------

ORACLES: dict[str, str] = {}


def oracle(key: str, select: str, *names: str, more: dict[str, str] | None = None) -> None:
    ORACLES[key] = with_tables(select, *names, more=more) if names or more else select


# sources and sinks
oracle("scan_incidents", "SELECT arrest_id, charge_1_description, charge_1_class, beat FROM incidents", "incidents")
oracle("scan_unit_beat_crosswalk", "SELECT unit, beat FROM beats", "beats")
oracle(
    "crosswalk_lookups",
    """SELECT 'micro' AS lookup, description || ' "x", y' AS key, micro_category AS value FROM xw GROUP BY ALL
UNION ALL SELECT 'macro', micro_category, macro_category FROM xw GROUP BY ALL
UNION ALL SELECT 'police', description || ' "x", y', cast(police_related AS varchar) FROM xw GROUP BY ALL""",
    "xw",
)
oracle("read_or_build", "SELECT arrest_id, beat, unit, arrest_year FROM prepared", "prepared")
oracle(
    "sink_roundtrip_parquet",
    "SELECT arrest_id, arrest_year, unit, beat, arrest_time, charge_2_class FROM prepared", "prepared",
)
oracle(
    "sink_roundtrip_csv",
    """SELECT arrest_id, '"a"' || chr(10) || ',' || charge_1_description AS charge_1_description, unit, beat,
       arrest_time FROM prepared""",
    "prepared",
)
oracle(
    "geo_points",
    """SELECT s_name AS dist_label, cast(s_suppkey AS varchar) AS dist_num,
       round(s_acctbal / 100, 6) AS lon, round(s_suppkey / 8.0::double, 6) AS lat FROM supplier""",
)

# schema and projection
oracle(
    "normalize_columns",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal AS c_acct_bal,
       c_mktsegment AS c_mktsegment FROM customer""",
)

PROFILED = """
SELECT arrest_id, district, beat, charge_1_class, charge_1_description, last_name,
       received_in_lockup AS lockup_date, middle_name AS date_kind,
       CASE arrest_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'False' END AS is_flagged,
       arrest_id % 100 AS small_number, (arrest_id % 1000) / 10.0::double AS tenth
FROM incidents"""


def _profile_number(col: str, source: str, target: str) -> str:
    return (
        f"SELECT '{col}' AS column_name, '{source}' AS source_type, count(*) AS n_records, "
        f"count(*) - count({col}) AS n_null, cast(NULL AS bigint) AS n_distinct, "
        f"cast(min({col}) AS double) AS min_value, cast(max({col}) AS double) AS max_value, "
        f"{target} AS target_type FROM rows"
    )


def int_target(col: str) -> str:
    arms = " ".join(
        f"WHEN min({col}) > {-(2 ** (b - 1))} AND max({col}) < {2 ** (b - 1) - 1} THEN '{t}'"
        for t, b in (("tinyint", 8), ("smallint", 16), ("int", 32))
    )
    return f"CASE {arms} ELSE 'bigint' END"


def float_target(col: str) -> str:
    same = f"cast(cast({col} AS float) AS double) IS NOT DISTINCT FROM {col}"
    return f"CASE WHEN bool_and({same}) THEN 'float' ELSE 'double' END"


def text_target(col: str) -> str:
    if "date_" in col or "_date" in col:
        return f"CASE WHEN count({col}) = count(try_cast({col} AS timestamp)) THEN 'timestamp' ELSE 'string' END"
    few = f"count(DISTINCT {col}) < 20 OR count(DISTINCT {col}) / count(*) < 0.1"
    flag = f"count({col}) > 0 AND bool_and(lower({col}) IN ('true', 'false'))"
    return f"CASE WHEN {flag} THEN 'boolean' WHEN {few} THEN 'category' ELSE 'string' END"


def _profile_text(col: str) -> str:
    return (
        f"SELECT '{col}', 'string', count(*), count(*) - count({col}), count(DISTINCT {col}), "
        f"NULL, NULL, {text_target(col)} FROM rows"
    )


oracle(
    "profile_columns",
    " UNION ALL ".join(
        [_profile_number(c, "bigint", int_target(c)) for c in ("arrest_id", "small_number")]
        + [_profile_number(c, "double", float_target(c)) for c in ("district", "beat", "tenth")]
        + [
            _profile_text(c)
            for c in (
                "charge_1_class", "charge_1_description", "last_name", "lockup_date", "date_kind",
                "is_flagged",
            )
        ]
    ),
    "incidents",
    more={"rows": PROFILED},
)


def _typed(columns: tuple[str, ...], target) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {target(c)} AS type_name, "
        f"round(cast(sum({c}) AS double), 2) AS total FROM lineitem"
        for c in columns
    )


oracle("narrow_ints", _typed(("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"), int_target))
oracle("narrow_floats", _typed(("l_quantity", "l_extendedprice", "l_discount"), float_target))
oracle(
    "detect_dates",
    """SELECT arrest_id, strftime(cast(received_in_lockup AS timestamp), '%Y-%m-%d %H:%M:%S') AS lockup_date,
       middle_name AS date_kind, 'timestamp' AS lockup_type, 'string' AS kind_type FROM incidents""",
    "incidents",
)
oracle(
    "detect_booleans",
    """SELECT arrest_id, CASE arrest_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_flagged,
       'boolean' AS type_name FROM incidents""",
    "incidents",
)


def _title(col: str) -> str:
    runs = f"regexp_extract_all({col}, '[A-Za-z]+|[^A-Za-z]+')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || lower(w[2:])), '')"


def _category_rows(col: str, name: str) -> str:
    value = f"CASE WHEN (SELECT {text_target(col).replace('date_kind', 'middle_name')} FROM incidents) = 'category' THEN {_title(col)} ELSE {col} END"
    return f"SELECT '{name}' AS column_name, {value} AS value FROM incidents"


oracle(
    "detect_categories",
    "SELECT column_name, value, count(*) AS n FROM ("
    + " UNION ALL ".join(
        _category_rows(c, n)
        for c, n in (
            ("charge_1_class", "charge_1_class"), ("charge_1_description", "charge_1_description"),
            ("last_name", "last_name"), ("middle_name", "kind"),
        )
    )
    + ") v GROUP BY column_name, value",
    "incidents",
)
oracle(
    "forced_casts",
    """SELECT arrest_id, try_cast(cb_no AS bigint) AS cb_no, try_cast(case_number AS bigint) AS case_number,
       try_cast(middle_name AS bigint) AS middle_name,
       strftime(cast(received_in_lockup AS timestamp), '%Y-%m-%d %H:%M:%S') AS received FROM incidents""",
    "incidents",
)
oracle(
    "redact",
    f"""SELECT (SELECT count(*) FROM incidents) AS n_rows, cast(count(*) AS int) AS n_columns,
       string_agg(column_name, ',' ORDER BY column_name) AS columns
FROM (SELECT unnest(json_keys(to_json(k))) AS column_name FROM
        (SELECT * EXCLUDE ({DROPPED}) FROM incidents WHERE arrest_id = 0) k) c""",
    "incidents",
)
oracle("prep_districts", "SELECT arrest_id, district FROM prepared", "prepared")
oracle(
    "prep_beats",
    f"""SELECT arrest_id, {key_text('wide', 4)} AS beat FROM
    (SELECT arrest_id, CASE WHEN arrest_id % 5 = 0 THEN beat + 12000.75 ELSE beat END AS wide FROM incidents) w""",
    "incidents",
)
oracle("date_parts", f"SELECT arrest_id, {', '.join(_DATE)} FROM prepared", "prepared")
oracle(
    "round_quarter_hour",
    f"""SELECT arrest_id, cast({quarters('arrest_date')} % 4 * 15 AS int) AS minute,
       strftime(make_timestamp({quarters('arrest_date')} * 900000000), '%Y-%m-%d %H:%M:%S') AS rounded
FROM incidents""",
    "incidents",
)
oracle(
    "time_of_day",
    f"""SELECT arrest_id, {_TIME['arrest_minute']} AS arrest_minute, {_TIME['arrest_time']} AS arrest_time,
       ({quarters('arrest_date')} % 96) * 0.25::double AS arrest_time_carried FROM incidents""",
    "incidents",
)
oracle(
    "surrogate_id",
    """SELECT event_id, event_type, value,
       row_number() OVER (ORDER BY event_type, event_id) - 1 AS arrest_id FROM events""",
)
oracle(
    "severity_codes",
    f"SELECT arrest_id, {', '.join(f'charge_{s}_class_cat_code' for s in SLOTS)} FROM prepared",
    "prepared",
)
oracle(
    "charge_type_bucket",
    "SELECT arrest_id, lead_charge_code AS code, lead_charge_code_type AS charge_type FROM flagged",
    "flagged",
)
oracle(
    "titlecase",
    """SELECT arrest_id, first_name, 'Oneil-' || cb_no AS last_name FROM incidents""",
    "incidents",
)
oracle(
    "category_domain",
    "SELECT DISTINCT charge_1_class FROM incidents WHERE charge_1_class IS NOT NULL", "incidents",
)
N_HOURS = "(SELECT count(DISTINCT arrest_hour) FROM prepared)"
ANGLE = f"round(CASE WHEN arrest_hour < {N_HOURS} THEN arrest_hour / {N_HOURS} * 2 * pi() END, 6)"
oracle("hour_angle", f"SELECT arrest_id, arrest_hour, {ANGLE} AS arrest_time_angle FROM prepared", "prepared")
oracle(
    "fill_keys", "SELECT arrest_id, coalesce(unit, '000') AS unit, coalesce(beat, '0000') AS beat FROM prepared",
    "prepared",
)

# filters
oracle(
    "filter_year",
    "SELECT o_orderkey, year(o_orderdate)::int AS o_year FROM orders WHERE year(o_orderdate) = 1995",
)
oracle(
    "unmapped",
    """SELECT arrest_id, charge_1_description FROM flagged
WHERE charge_1_description IS NOT NULL AND lead_charge_police_related IS NULL""",
    "flagged",
)
oracle(
    "training_pairs",
    "SELECT description, micro, n_train, n_test FROM ruled WHERE n_slot_1 > 0 AND micro IS NOT NULL",
    "ruled",
)

COUNT_KEYS = (
    "lead_charge_police_related, lead_charge_code, arrest_year, arrest_month, arrest_day, arrest_hour"
)
HOURLY = f"""
SELECT {COUNT_KEYS}, lead_charge_code_type, count(arrest_id) AS arrest_id_count FROM flagged
WHERE lead_charge_police_related IS NOT NULL GROUP BY ALL"""
ZSCORED = """
SELECT *, CASE WHEN stddev_pop(arrest_id_count) OVER w > 0 THEN
       (arrest_id_count - avg(arrest_id_count) OVER w) / stddev_pop(arrest_id_count) OVER w END AS z
FROM hourly WINDOW w AS (PARTITION BY lead_charge_code_type)"""
TYPES = ", ".join(text(t) for t in CHARGE_TYPES)
RADAR = f"""
SELECT lead_charge_code_type AS chart, *, abs(z) AS absolute FROM zscored
WHERE abs(z) <= 3 AND lead_charge_code_type IN ({TYPES})
UNION ALL SELECT 'All', *, NULL FROM zscored"""
ANALYSIS = {"hourly": HOURLY, "zscored": ZSCORED, "radar": RADAR}
oracle(
    "zscore_filter", f"SELECT {COUNT_KEYS}, arrest_id_count FROM zscored WHERE abs(z) <= 1.5",
    "flagged", more=ANALYSIS,
)

# joins and rules
oracle("lookup_unit", "SELECT arrest_id, beat, unit FROM prepared", "prepared")
oracle(
    "direct_match",
    """SELECT d.description, micro_category AS micro, police_related AS police, n_slot_1, n_slot_2
FROM descriptions d LEFT JOIN xw USING (description)""",
    "descriptions", "xw",
)
oracle(
    "macro_rollup",
    "SELECT description, micro, macro FROM ruled LEFT JOIN macros USING (micro)", "ruled", "macros",
)
oracle(
    "unmatched_anti",
    "SELECT description FROM descriptions EXCEPT SELECT description FROM xw", "descriptions", "xw",
)
oracle("fuzzy_match", "SELECT text, key, distance FROM fuzzy", "fuzzy")
oracle(
    "coalesce_update",
    """SELECT arrest_id,
       coalesce(unit, CASE WHEN event_id % 3 = 0 THEN lpad(event_type, 8, '_') END) AS unit,
       coalesce(lead_charge_police_related, CASE WHEN event_id % 3 = 0 THEN value > 50 END)
         AS charge_1_description_police_related
FROM flagged JOIN events ON event_id = arrest_id""",
    "flagged",
)
oracle("unpivot_charges", "SELECT arrest_id, slot, description FROM long", "long")
oracle(
    "pivot_charges",
    f"""SELECT arrest_id, {', '.join(f'charge_{s}_description' for s in SLOTS)} FROM incidents
WHERE coalesce({', '.join(f'charge_{s}_description' for s in SLOTS)}) IS NOT NULL""",
    "incidents",
)
oracle(
    "dedupe_lookup",
    """SELECT p_name, p_type, p_type_last_row FROM
  (SELECT p_name, arg_max(p_type, place) AS p_type FROM
     (SELECT p_name, p_type, min(p_partkey) AS place FROM part GROUP BY ALL) a GROUP BY 1) x
JOIN (SELECT p_name, arg_max(p_type, p_partkey) AS p_type_last_row FROM part GROUP BY 1) y USING (p_name)""",
)
oracle(
    "manual_rules",
    """SELECT d.description, coalesce(micro_category, CASE WHEN d.description LIKE 'CTA - %' THEN 'Nuisance' END) AS micro,
       CASE WHEN d.description LIKE 'CTA - %' THEN 'Other' END AS macro
FROM descriptions d LEFT JOIN xw USING (description)""",
    "descriptions", "xw",
)
oracle(
    "cascade_methods",
    "SELECT description, micro, police, micro_method, police_method FROM ruled", "ruled",
)

# aggregates
oracle("hourly_counts", f"SELECT {COUNT_KEYS}, arrest_id_count FROM hourly", "flagged", more=ANALYSIS)
oracle("hourly_counts_incremental", f"SELECT {COUNT_KEYS}, arrest_id_count FROM hourly", "flagged", more=ANALYSIS)
oracle(
    "total_count",
    "SELECT count(*) AS n_records FROM flagged WHERE lead_charge_police_related IS NOT NULL", "flagged",
)
oracle(
    "null_key_count",
    "SELECT count(*) AS n_dropped FROM flagged WHERE lead_charge_police_related IS NULL", "flagged",
)
oracle(
    "year_span",
    "SELECT min(year(o_orderdate))::int AS min_year, max(year(o_orderdate))::int AS max_year FROM orders",
)
oracle("distinct_hours", "SELECT DISTINCT cast(arrest_hour AS varchar) AS arrest_hour FROM prepared", "prepared")
oracle(
    "zscore",
    f"SELECT {COUNT_KEYS}, arrest_id_count, lead_charge_code_type, round(z, 6) AS zscore FROM zscored",
    "flagged", more=ANALYSIS,
)
oracle(
    "radar_series",
    f"""SELECT chart, {COUNT_KEYS}, arrest_id_count, lead_charge_code_type,
       round(absolute, 6) AS arrest_id_count_zscore, {ANGLE} AS arrest_time_angle FROM radar""",
    "flagged", more=ANALYSIS,
)
oracle(
    "pct_of_total",
    """SELECT chart, cast(sum(arrest_id_count) AS bigint) AS n_records,
       round_even(100.0::double * sum(arrest_id_count) / (SELECT sum(arrest_id_count) FROM hourly), 1) AS pct_of_total
FROM radar GROUP BY chart""",
    "flagged", more=ANALYSIS,
)
oracle("preview", "SELECT arrest_id, unit, beat FROM prepared ORDER BY arrest_id LIMIT 5", "prepared")

# densities
RAW = {
    "unit": """SELECT lead_charge_code_type, NULL::boolean AS lead_charge_police_related, unit,
       arrest_time AS x FROM flagged WHERE unit IS NOT NULL""",
    "flag": """SELECT lead_charge_code_type, lead_charge_police_related, coalesce(unit, '000') AS unit,
       arrest_time AS x FROM flagged WHERE lead_charge_police_related IS NOT NULL""",
}
PANEL_KEYS = {
    "unit": "lead_charge_code_type",
    "flag": "lead_charge_code_type, lead_charge_police_related, unit",
}
CURVE_KEYS = {"unit": "lead_charge_code_type, unit", "flag": PANEL_KEYS["flag"]}


def density_tables(view: str) -> dict[str, str]:
    panel, curve = PANEL_KEYS[view], CURVE_KEYS[view]
    return {
        "raw_times": RAW[view],
        "ranges": f"""
SELECT {panel}, min(x) AS lo, max(x) AS hi, count(*) AS total,
       2.0 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) * pow(count(*), -1.0/3.0) AS fd,
       (max(x) - min(x)) / (log2(count(*)) + 1) AS sturges
FROM raw_times GROUP BY {panel}""",
        "panels": f"""
SELECT {panel}, total, lo AS grid_lo, hi AS grid_hi,
       CASE WHEN hi > lo THEN lo ELSE lo - 0.5 END AS lo,
       CASE WHEN hi > lo THEN cast(ceil((hi - lo) / CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END) AS int) ELSE 1 END AS n_bins,
       CASE WHEN hi > lo THEN (hi - lo) / ceil((hi - lo) / CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END) ELSE 1.0::double END AS bin_width
FROM ranges""",
        "binned": f"""
SELECT {curve}, least(cast(floor((x - lo) / bin_width) AS int), n_bins - 1) AS bin, count(*) AS n
FROM raw_times JOIN panels USING ({panel}) GROUP BY ALL""",
        "hist": f"""
SELECT {curve}, g.bin, lo + g.bin * bin_width AS bin_start, bin_width, coalesce(b.n, 0) AS n,
       coalesce(b.n, 0) / (total * bin_width) AS density
FROM (SELECT *, unnest(range(n_bins))::int AS bin FROM
        (SELECT DISTINCT {curve} FROM raw_times) c JOIN panels USING ({panel})) g
LEFT JOIN binned b USING ({curve}, bin)""",
        "spreads": f"""
SELECT {curve}, stddev_samp(x) * pow(count(*), -0.2) AS h FROM raw_times GROUP BY {curve}
HAVING count(*) > 1 AND stddev_samp(x) > 0""",
        "kde": f"""
SELECT {curve}, point, gx AS x, sum(exp(-pow((gx - r.x) / h, 2) / 2)) / (any_value(total) * any_value(h) * sqrt(2 * pi())) AS density
FROM (SELECT *, grid_lo + (grid_hi - grid_lo) * point / 199 AS gx FROM
        (SELECT *, unnest(range(200))::int AS point FROM spreads JOIN panels USING ({panel})) q) g
JOIN raw_times r USING ({curve}) GROUP BY ALL""",
    }


def _shown(view: str) -> str:
    return CURVE_KEYS[view]


for _view, _suffix in (("unit", ""), ("flag", "_by_flag")):
    oracle(
        f"unit_time_hist{_suffix}",
        f"""SELECT {_shown(_view)}, bin, round(bin_start, 6) AS bin_start, round(bin_width, 6) AS bin_width,
       n, round(density, 6) AS density FROM hist""",
        "flagged", more=density_tables(_view),
    )
    oracle(
        f"unit_time_kde{_suffix}",
        f"SELECT {_shown(_view)}, point, round(x, 6) AS x, round(density, 6) AS density FROM kde",
        "flagged", more=density_tables(_view),
    )


def _stats_tables() -> dict[str, str]:
    out = {}
    for view in ("unit", "flag"):
        for name, sql in density_tables(view).items():
            for other in ("raw_times", "ranges", "panels", "binned", "spreads"):
                sql = sql.replace(f"FROM {other}", f"FROM {view}_{other}").replace(
                    f"JOIN {other} ", f"JOIN {view}_{other} "
                )
            out[f"{view}_{name}"] = sql
    return out


def _stats_select(view: str, kind: str) -> str:
    chart = {"unit": "by_unit", "flag": "by_flag_and_unit"}[view]
    flag = "NULL::boolean" if view == "unit" else "lead_charge_police_related"
    return (
        f"SELECT '{chart}' AS chart, '{kind}' AS kind, lead_charge_code_type, "
        f"{flag} AS lead_charge_police_related, unit, count(*) AS n_points, "
        f"round(sum(density), 6) AS density_sum FROM {view}_{kind} GROUP BY ALL"
    )


oracle(
    "unit_stats",
    " UNION ALL ".join(_stats_select(v, k) for v in ("unit", "flag") for k in ("hist", "kde")),
    "flagged", more=_stats_tables(),
)

# network
EDGES = {
    "edges": """SELECT DISTINCT coalesce(beat, '0000') AS src, coalesce(unit, '000') AS dst,
       'assignedTo' AS rel FROM prepared""",
}
oracle(
    "network_vertices",
    "SELECT dst AS id, 'unit' AS type FROM edges UNION SELECT src, 'beat' FROM edges",
    "prepared", more=EDGES,
)
oracle("network_edges", "SELECT src, dst, rel FROM edges", "prepared", more=EDGES)
oracle(
    "beats_per_unit", "SELECT dst AS unit, count(*) AS n_beats FROM edges GROUP BY dst",
    "prepared", more=EDGES,
)

oracle(
    "network_patterns",
    """SELECT 'beats' AS pattern, src AS beat, dst AS unit FROM edges
UNION ALL SELECT DISTINCT 'near', b.src, b.dst FROM edges a JOIN edges b ON a.dst = b.dst WHERE a.src = '0000'""",
    "prepared", more=EDGES,
)

# text and classification
oracle("clean_text", "SELECT description, text FROM ruled_text", "ruled_text")
oracle("clean_documents", f"SELECT doc_id, {clean('text')} AS text FROM documents")
WORDS_OF = "SELECT unnest(string_split(text, ' ')) AS word FROM {}"
oracle(
    "clean_text_stemmed", "SELECT doc_id, text FROM stemmed",
    more={
        "cleaned": f"SELECT doc_id, {clean('text')} AS text FROM documents", **stem_tables(WORDS_OF.format("cleaned")),
        "stemmed": stemmed("doc_id", "cleaned"),
    },
)
oracle("train_test_split", f"SELECT event_id, {holdout('event_id')} < 7 AS is_train FROM events")
oracle(
    "token_counts",
    f"""SELECT doc_id, word, count(*) AS n FROM
  (SELECT doc_id, unnest({words('text')}) AS word FROM documents) w GROUP BY doc_id, word""",
)
MICRO_NB = naive_bayes(
    "SELECT text, micro AS label, n_train AS n FROM ruled_text WHERE n_train > 0 AND micro IS NOT NULL",
    "SELECT description AS id, text FROM ruled_text",
)
oracle(
    "nb_weights", "SELECT label, word, round(weight, 6) AS weight FROM nb_weights WHERE seen",
    "ruled_text", more=MICRO_NB,
)
for _key in ("nb_predict", "model_roundtrip"):
    oracle(
        _key, "SELECT id AS description, prediction, round(score, 6) AS score FROM nb_best",
        "ruled_text", more=MICRO_NB,
    )
for _label, _source in (("lang", "documents"), ("toxic", "documents LEFT JOIN labels USING (doc_id)")):
    oracle(
        f"nb_documents_{_label}",
        f"SELECT doc_id, is_train, {_label}, prediction FROM docs JOIN nb_best ON id = doc_id",
        more={
            "docs": f"""SELECT doc_id, {clean('text')} AS text, {_label}, {holdout('doc_id')} < 7 AS is_train
FROM {_source}""",
            **naive_bayes(
                f"SELECT text, {_label} AS label, 1 AS n FROM docs WHERE is_train AND {_label} IS NOT NULL",
                "SELECT doc_id AS id, text FROM docs",
            ),
        },
    )


def _renamed(tables: dict[str, str], prefix: str) -> dict[str, str]:
    out = {}
    for name, sql in tables.items():
        for other in tables:
            sql = sql.replace(f"FROM {other}", f"FROM {prefix}{other}")
            sql = sql.replace(f"JOIN {other} ", f"JOIN {prefix}{other} ")
        out[prefix + name] = sql
    return out


POLICE_NB = naive_bayes(
    "SELECT text, police::int AS label, n_train AS n FROM ruled_text WHERE n_train > 0 AND police IS NOT NULL",
    "SELECT description AS id, text FROM ruled_text",
)
RESOLVED = {
    **_renamed(MICRO_NB, "m_"),
    **_renamed(POLICE_NB, "p_"),
    "resolved": """
SELECT r.* EXCLUDE (micro, police, micro_method, police_method), coalesce(r.micro, m.prediction) AS micro,
       coalesce(r.police, p.prediction <> 0) AS police,
       coalesce(r.micro_method, 'nlp') AS micro_method, coalesce(r.police_method, 'nlp') AS police_method,
       r.micro AS known_micro, r.police AS known_police, m.prediction AS said_micro, p.prediction AS said_police
FROM ruled_text r JOIN m_nb_best m ON m.id = r.description JOIN p_nb_best p ON p.id = r.description""",
}


# The same on stemmed texts: the table of texts is replaced, all that builds on it stays.
STEMMED = {
    **stem_tables(WORDS_OF.format("ruled_text")),
    "stemmed_text": stemmed("description", "ruled_text"),
    "ruled_stemmed": "SELECT r.* EXCLUDE (text), s.text FROM ruled_text r JOIN stemmed_text s USING (description)",
    **{name: sql.replace("FROM ruled_text", "FROM ruled_stemmed") for name, sql in RESOLVED.items()},
}


def resolved(key: str, select: str, *names: str, more: dict[str, str] = RESOLVED) -> None:
    oracle(key, select, "ruled_text", "macros", *names, more=more)


resolved(
    "nlp_micro",
    "SELECT description, micro, macro, micro_method FROM resolved LEFT JOIN macros USING (micro)",
)
resolved("nlp_police", "SELECT description, police, police_method FROM resolved")
resolved(
    "coverage_report",
    "SELECT slot, target, method, sum(n)::bigint AS n FROM ("
    + " UNION ALL ".join(
        f"SELECT {s} AS slot, '{t}' AS target, {t}_method AS method, n_slot_{s} AS n FROM resolved"
        for s in SLOTS for t in ("micro", "police")
    )
    + ") c WHERE n > 0 GROUP BY slot, target, method",
)
resolved(
    "accuracy",
    """SELECT coalesce(sum(n_test) FILTER (known_micro = said_micro), 0)::bigint AS n_correct,
       sum(n_test)::bigint AS n,
       round(coalesce(sum(n_test) FILTER (known_micro = said_micro), 0) / sum(n_test), 6) AS accuracy
FROM resolved WHERE known_micro IS NOT NULL""",
)
for _key in ("confusion_matrix", "confusion_csv"):
    resolved(
        _key,
        """, tested AS (SELECT * FROM resolved WHERE known_micro IS NOT NULL AND n_test > 0),
seen AS (SELECT known_micro AS micro FROM tested UNION SELECT said_micro FROM tested)
SELECT a.micro AS label, b.micro AS prediction, coalesce(sum(r.n_test), 0)::bigint AS n
FROM seen a CROSS JOIN seen b
LEFT JOIN tested r ON r.known_micro = a.micro AND r.said_micro = b.micro GROUP BY a.micro, b.micro""",
    )
resolved(
    "binary_confusion",
    "SELECT "
    + ", ".join(
        f"coalesce(sum(n_test) FILTER (known_police = {truth} AND said_police = {said}), 0)::bigint AS {name}"
        for name, truth, said in (("tn", "false", 0), ("fp", "false", 1), ("fn", "true", 0), ("tp", "true", 1))
    )
    + " FROM resolved",
)

oracle(
    "attach_large",
    "SELECT CASE WHEN arrest_id % 5 <> 0 THEN arrest_id // 3 END AS arrest_id, "
    + ", ".join(
        f"charge_{s}_description, v{s}.micro_category AS charge_{s}_description_category_micro, "
        f"v{s}.macro_category AS charge_{s}_description_category_macro, "
        f"v{s}.police_related AS charge_{s}_description_police_related"
        for s in SLOTS
    )
    + " FROM incidents "
    + " ".join(f"LEFT JOIN xw v{s} ON v{s}.description = charge_{s}_description" for s in SLOTS),
    "incidents", "xw",
)

# whole runs
oracle("prepare_incidents", "SELECT * FROM prepared", "prepared")
CLASSIFIED = (
    "SELECT arrest_id, "
    + ", ".join(
        f"r{s}.micro AS charge_{s}_description_category_micro, x{s}.macro AS charge_{s}_description_category_macro, "
        f"r{s}.police AS charge_{s}_description_police_related"
        for s in SLOTS
    )
    + " FROM incidents "
    + " ".join(
        f"LEFT JOIN resolved r{s} ON r{s}.description = charge_{s}_description "
        f"LEFT JOIN macros x{s} ON x{s}.micro = r{s}.micro"
        for s in SLOTS
    )
)
resolved("classify_incidents", CLASSIFIED, "incidents")
resolved("classify_incidents_stemmed", CLASSIFIED, "incidents", more=STEMMED)
