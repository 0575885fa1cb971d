"""Profile tables derived from the star-schema test tables.

The column expressions are plain SQL that Spark and other engines read alike, so one text serves
the queries and the SQL they are checked against.
"""

from __future__ import annotations

import datetime as dt
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilegate import schemas as S

REFERENCE_DATE = dt.date(2025, 1, 1)
SALT = "fixture-salt"
ROWS_A_TASK = 10_000

_COUNTRIES = ",".join(S.SOURCE_COUNTRY_CODES)
_CODES = ",".join(S.SOURCE_COUNTRY_CODES.values())
_OFFSETS = "+1:00,3:30,-11:45,+13:45,+14:15,+02:75,east,-13:00"

K = "c_custkey"
PROFILE_SQL = {
    "k": K,
    "source": f"CASE WHEN {K} % 10 = 9 THEN 'crm' ELSE 'random_user' END",
    "source_user_id": f"'user-' || CAST({K} AS STRING)",
    "gender": f"CASE WHEN {K} % 3 = 0 THEN 'female' WHEN {K} % 3 = 1 THEN 'male' END",
    "title": f"CASE WHEN {K} % 61 = 9 THEN 'M' || chr(133) || 's' ELSE 'Ms' END",
    "first_name": f"CASE WHEN {K} % 53 = 5 THEN repeat('a', 513) WHEN {K} % 59 = 7 THEN 'Gr' || chr(9) || 'ace' "
    f"ELSE 'First' || CAST({K} AS STRING) END",
    "last_name": "c_name",
    "street_number": f"CAST({K} % 200 AS BIGINT)",
    "street_name": f"CASE WHEN {K} % 67 = 11 THEN repeat('é', 512) WHEN {K} % 71 = 12 THEN repeat('é', 513) "
    "ELSE c_mktsegment || ' Road' END",
    "city": "n_name",
    "state": "CAST(NULL AS STRING)",
    "country": f"CASE WHEN n_nationkey < 21 THEN split_part('{_COUNTRIES}', ',', CAST(n_nationkey + 1 AS INT)) "
    "WHEN n_nationkey = 21 THEN '  ' ELSE 'Ruritania' END",
    "country_code": f"CASE WHEN {K} % 17 = 3 THEN 'ZZ' WHEN {K} % 17 = 5 THEN 'gb' WHEN n_nationkey >= 21 THEN NULL "
    f"ELSE split_part('{_CODES}', ',', CAST(n_nationkey + 1 AS INT)) END",
    "postcode": f"CAST(10000 + {K} % 7919 AS STRING)",
    "latitude": f"CASE WHEN {K} % 13 = 4 THEN '97.25' WHEN {K} % 13 = 5 THEN 'up' WHEN {K} % 13 = 6 THEN NULL "
    "ELSE '48.8584' END",
    "longitude": f"CASE WHEN {K} % 19 = 4 THEN '-190.5' ELSE '2.2945' END",
    "timezone_offset": f"CASE WHEN {K} % 9 = 8 THEN NULL ELSE split_part('{_OFFSETS}', ',', CAST({K} % 9 + 1 AS INT)) END",
    "timezone_description": "CAST(NULL AS STRING)",
    "email": f"CASE WHEN {K} % 29 = 3 THEN 'grace-at-example.net' ELSE 'u' || CAST({K} AS STRING) || '@example.com' END",
    "username": f"CASE WHEN {K} % 31 = 2 THEN '   ' ELSE 'name' || CAST({K} AS STRING) END",
    "date_of_birth": f"CASE WHEN {K} % 41 = 0 THEN DATE '1899-07-04' WHEN {K} % 43 = 1 THEN NULL "
    f"ELSE DATE '1945-01-01' + CAST(({K} * 37) % 26000 AS INT) END",
    "registered_at": f"CASE WHEN {K} % 23 = 2 THEN NULL ELSE DATE '2010-01-01' + CAST(({K} * 13) % 6000 AS INT) END",
    "phone": f"CASE WHEN {K} % 73 = 1 THEN chr(127) ELSE '020 ' || CAST({K} AS STRING) END",
    "cell": "CAST(NULL AS STRING)",
    "picture_large": f"CASE WHEN {K} % 7 = 0 THEN 'http://example.com/l.jpg' ELSE 'https://example.com/l.jpg' END",
    "picture_medium": f"CASE WHEN {K} % 79 = 3 THEN 'https://example.com/' || repeat('m', 2048) "
    f"WHEN {K} % 83 = 4 THEN 'HTTPS://example.com/m.jpg' END",
    "picture_thumbnail": f"CASE WHEN {K} % 11 = 1 THEN 'https:///t.jpg' WHEN {K} % 11 = 2 THEN NULL "
    "ELSE 'https://example.com/t.jpg' END",
    "nationality": f"CASE WHEN {K} % 37 = 3 THEN 'GBR' WHEN {K} % 37 = 4 THEN 'gb' ELSE 'GB' END",
}

# The same profiles as text before any parsing, with more ways to be malformed.
_DATES = {
    0: "'2000-02-30'",
    1: "'2000'",
    2: "'12:30'",
    3: "'1990-05-06 07:08'",
    4: "'1990-05-06T07:08:09.123456+02:00'",
    5: "'1990-05-06T23:30:00-0300'",
    6: "'not-a-date'",
    7: "' 1990-05-06 '",
    8: "'1990-05-06t07:08:09z'",
    9: "''",
}
_EMAILS = {
    0: "' Ada@EXAMPLE.com '",
    1: "'a..b@example.com'",
    2: "'a@b@example.com'",
    3: "'a@localhost'",
    4: "'a@-bad.com'",
    5: "'.a@example.com'",
    6: "'a+tag@sub.example.co.uk'",
    7: "'a b@example.com'",
    8: "repeat('x', 65) || '@example.com'",
    9: "'a@mail.test'",
    10: "'a@mail.-com'",
    11: "'a@mail.co-m'",
}
_URLS = {
    0: "'not-a-url'",
    1: "'ftp://example.com/l.jpg'",
    2: "'https://user@example.com:8080/a?b#c'",
    3: "'https://?q'",
    4: "' https://example.com/l.jpg'",
    5: "'https://exa mple.com/'",
    6: "'https:example.com'",
    7: "'https://[::1]/x'",
    8: "'https://example.com:99999/x'",
    9: "'https://example.com:65535'",
    10: "'http://example.com:/'",
}
_NUMBERS = {0: "'1d'", 1: "'NaN'", 2: "' 12.5 '", 3: "'-90'", 4: "'1e1'", 5: "''", 6: "'.5'", 7: "'90.0001'"}


def _pick(modulus: int, cases: dict[int, str], otherwise: str) -> str:
    whens = " ".join(f"WHEN {K} % {modulus} = {i} THEN {v}" for i, v in cases.items())
    return f"CASE {whens} ELSE {otherwise} END"


RAW_SQL = PROFILE_SQL | {
    "schema_version": f"CASE WHEN {K} % 89 = 1 THEN '2.0' WHEN {K} % 89 = 2 THEN NULL ELSE '1.0' END",
    "event_type": f"CASE WHEN {K} % 97 = 1 THEN 'UserDeleted' WHEN {K} % 97 = 2 THEN NULL ELSE 'UserCreated' END",
    "source": f"CASE WHEN {K} % 101 = 1 THEN ' random_user' || chr(9) WHEN {K} % 101 = 2 THEN '\u2003' ELSE {PROFILE_SQL['source']} END",
    "first_name": f"CASE WHEN {K} % 103 = 1 THEN '\u00a0Ada\u3000' WHEN {K} % 103 = 2 THEN '' ELSE {PROFILE_SQL['first_name']} END",
    "country_code": f"CASE WHEN {K} % 107 = 1 THEN 'GBR' WHEN {K} % 107 = 2 THEN ' GB ' ELSE {PROFILE_SQL['country_code']} END",
    "date_of_birth": _pick(109, _DATES, f"CAST({PROFILE_SQL['date_of_birth']} AS STRING) || 'T00:00:00Z'"),
    "registered_at": _pick(113, _DATES, f"CAST({PROFILE_SQL['registered_at']} AS STRING) || 'T12:00:00.000Z'"),
    "email": _pick(127, _EMAILS, PROFILE_SQL["email"]),
    "picture_large": _pick(131, _URLS, PROFILE_SQL["picture_large"]),
    "latitude": _pick(137, _NUMBERS, PROFILE_SQL["latitude"]),
}

FROM_SQL = "FROM customer JOIN nation ON c_nationkey = n_nationkey"


def select_sql(columns: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f"{expr} AS {name}" for name, expr in columns.items()) + " " + FROM_SQL


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(str(PurePosixPath(folder) / f"{name}.parquet"))


def spread(rows: DataFrame) -> DataFrame:
    """Stored rows dealt to one task for each ``ROWS_A_TASK`` of them.

    Scans are split by bytes, but a customer takes a few bytes of its file and becomes kilobytes of JSON.
    """
    tasks = -(-rows.count() // ROWS_A_TASK)  # the files' footers tell, unless rows are filtered
    return rows.repartition(tasks) if tasks > 1 else rows


def _derive(spark: SparkSession, folder: str, columns: dict[str, str]) -> DataFrame:
    # Spark broadcasts the nation side by its own size threshold, or sorts both sides beyond it.
    customers = spread(table(spark, folder, "customer"))
    joined = customers.join(table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey"))
    return joined.select(*[F.expr(expr).alias(name) for name, expr in columns.items()])


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    """One profile per customer, dates and integers typed."""
    return _derive(spark, folder, PROFILE_SQL)


def raw_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """One profile per customer as the source would send it, all text but the street number."""
    return _derive(spark, folder, RAW_SQL)


def profile_events(spark: SparkSession, folder: str, columns: dict[str, str] = PROFILE_SQL) -> DataFrame:
    """One profile event per order of a customer, with the order date as its ingestion time."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("event_id"), "o_custkey", F.col("o_orderdate").cast("timestamp").alias("ingested_at")
    )
    return orders.join(_derive(spark, folder, columns), F.expr("o_custkey = k")).drop("o_custkey")
