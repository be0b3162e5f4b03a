"""Postgres, SQL Server and Snowflake through Spark's JDBC source."""

from __future__ import annotations

import re
from collections.abc import Mapping
from urllib.parse import parse_qsl, unquote, urlencode, urlsplit

from pyspark.sql import DataFrame, SparkSession

from ferry.sources.params import Param, inline_params, jdbc_literal
from ferry.sources.splits import depth_predicates, depth_query, hash_predicates, modulo_predicates, range_predicates

DRIVERS = {
    "postgres": "org.postgresql.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "snowflake": "net.snowflake.client.jdbc.SnowflakeDriver",
}


# Remainder of a hash of a column: the databases' own hash functions; in Spark one that other engines have too.
HASHES = {
    "postgres": "MOD(ABS(CAST(HASHTEXT(CAST({} AS TEXT)) AS BIGINT)), {})",
    "sqlserver": "(ABS(CAST(CHECKSUM({}) AS BIGINT)) % {})",
    "snowflake": "MOD(ABS(HASH({})), {})",
    "spark": "MOD(CAST(CONV(LEFT(MD5(CAST({} AS STRING)), 8), 16, 10) AS BIGINT), {})",
}

# Text of a query outside of quotes, brackets and comments.
_QUIET = re.compile(r"'(?:''|[^'])*'|\"[^\"]*\"|\[[^\]]*\]|`[^`]*`|--[^\n]*|/\*.*?\*/|\$(\w*)\$.*?\$\1\$", re.S)


def _blanked(sql: str) -> str:
    """The query with quoted text and comments as blanks, of the same length."""
    return _QUIET.sub(lambda m: " " * len(m[0]), sql)


# What makes a query's rows depend on the run. Rows picked by number or by a number given to them, the first
# of several, and the databases' own random values.
_UNSTABLE = re.compile(
    r"\b(LIMIT|TOP|OFFSET|FETCH\s+(FIRST|NEXT)|(TABLE)?SAMPLE|QUALIFY|DISTINCT\s+ON)\b|\)\s*(FILTER\s*\(.*?\)\s*)?OVER(\s*\(|\s+(?!FROM\b)\w)"
    r"|\b(RAND|RANDN|RANDOM|RANDSTR|UNIFORM|NORMAL|ZIPF|SEQ[1248]|SETSEED|NEWID|NEWSEQUENTIALID|CRYPT_GEN_RANDOM|GEN_RANDOM_UUID|GEN_RANDOM_BYTES"
    r"|UUID|UUID_STRING|UUID_GENERATE_V[14](MC)?|UUIDV[47]|NEXTVAL|ANY_VALUE|MONOTONICALLY_INCREASING_ID)\s*\(|\bNEXT\s+VALUE\s+FOR\b", re.I | re.S,
)


def limits_rows(sql: str) -> bool:
    """Whether a query picks or makes some of its rows by number, by a window, or by chance: run anew for each split it may
    have others, so that rows would be lost or come twice."""
    return bool(_UNSTABLE.search(_blanked(sql)))


def split_with(sql: str) -> tuple[str, str]:
    """A query as its leading WITH clause and the rest; databases that take no WITH inside of brackets get it in front."""
    text, depth = _blanked(sql), 0
    if not re.match(r"\s*WITH\b", text, re.I):
        return "", sql
    for m in re.finditer(r"[()]|\bSELECT\b", text, re.I):
        if m[0] in "()":
            depth += 1 if m[0] == "(" else -1
        elif depth == 0:
            return sql[: m.start()].strip(), sql[m.start() :]
    raise ValueError("a query that begins WITH has no SELECT")


def keeps_uuid_order(url: str) -> bool:
    """SQL Server URL flag: leave the byte order of UUIDs alone."""
    return dict(parse_qsl(urlsplit(url).query)).get("KeepOriginalUUID") == "true"


def jdbc_options(url: str, fetch_size: int = 10000) -> dict[str, str]:
    """Connection options of a `postgres://`, `sqlserver://` or `snowflake://` URL."""
    parts = urlsplit(url)
    dialect = parts.scheme
    if dialect not in DRIVERS:
        raise ValueError(f"unsupported source: {dialect!r}")
    query = dict(parse_qsl(parts.query, keep_blank_values=True))
    host = parts.hostname or ""
    path = [unquote(p) for p in parts.path.split("/") if p]
    options = {"driver": DRIVERS[dialect], "fetchsize": str(fetch_size), "preferTimestampNTZ": "true"}
    if parts.username:
        options["user"] = unquote(parts.username)
    if parts.password:
        options["password"] = unquote(parts.password)
    port = f":{parts.port}" if parts.port else ""
    if dialect == "postgres":
        address = f"jdbc:postgresql://{host}{port}/{path[0] if path else ''}"
        options["url"] = address + (f"?{urlencode(query)}" if query else "")
    elif dialect == "sqlserver":
        query.pop("KeepOriginalUUID", None)
        database = query.pop("database", None)
        if path:
            query["instanceName"] = path[0]
        if database:
            query["databaseName"] = database
        settings = "".join(f";{k}={{{v}}}" if ";" in v else f";{k}={v}" for k, v in query.items())
        options["url"] = f"jdbc:sqlserver://{host}{port}{settings}"
    else:
        account = host if "." in host else f"{host}.snowflakecomputing.com"
        query.update(zip(("db", "schema"), path))
        options["url"] = f"jdbc:snowflake://{account}{port}/" + (f"?{urlencode(query)}" if query else "")
    return options


def split_predicates(dialect: str, column: str, low: object, high: object, parts: int, by: str = "range") -> list[str]:
    if by == "modulo":
        return modulo_predicates(column, parts, "({} % {})" if dialect == "sqlserver" else "MOD({}, {})")
    if by == "hash":
        return hash_predicates(column, parts, HASHES[dialect])
    if by != "range":
        raise ValueError(f"split must be range, depth, modulo or hash: {by!r}")
    return range_predicates(column, low, high, parts, lambda value: jdbc_literal(value, dialect))


def read_jdbc(
    spark: SparkSession,
    url: str,
    sql: str,
    params: Mapping[str, Param] | None = None,
    partition_column: str = "",
    partitions: int = 1,
    split: str = "range",
    fetch_size: int = 10000,
) -> DataFrame:
    """Result of a query, fetched by `partitions` connections side by side.

    `partition_column` may be any expression the database can compare (or, with `split="modulo"`,
    an integer one, with `split="hash"` one of any type). All rows of one value go to one reader.

    `range` cuts between the lowest and the highest value into equal strides, `depth` at the quantiles, so that parts of
    skewed keys and of text hold as many rows each; the database sorts the column once for that. Both let an index serve
    each reader. For `modulo` and `hash` every reader scans the whole table: they are for small tables or many columns.
    Each part is a query of its own and sees the table as it is when it runs: read from a snapshot or a table at rest.
    """
    dialect = urlsplit(url).scheme
    options = jdbc_options(url, fetch_size)
    text = inline_params(sql, params, dialect).strip().rstrip(";")
    if dialect == "sqlserver":
        before, text = split_with(text)
        if before:
            options["prepareQuery"] = before
    text += "\n"  # ends a comment before the bracket that follows
    reader = spark.read.format("jdbc").options(**options)
    if not partition_column or partitions <= 1:
        return reader.option("query", text).load()
    if limits_rows(text):
        raise ValueError("a query that limits its rows, or picks them by a window or by chance, cannot be split: each part would run it anew and may get other rows")
    table = f"({text}) ferry_source"
    rest = {k: v for k, v in options.items() if k != "url"}
    if split == "depth":
        cuts = reader.option("query", depth_query(dialect, partition_column, partitions, table)).load().first()
        predicates = depth_predicates(partition_column, list(cuts or []), lambda value: jdbc_literal(value, dialect))
        return spark.read.jdbc(options["url"], table, predicates=predicates, properties=rest)
    low = high = None
    if split == "range":
        # The database answers with one row; Spark would otherwise fetch the column to find them.
        ends = f"SELECT MIN({partition_column}) AS low, MAX({partition_column}) AS high FROM {table}"
        low, high = reader.option("query", ends).load().first()
    predicates = split_predicates(dialect, partition_column, low, high, partitions, split)
    return spark.read.jdbc(options["url"], table, predicates=predicates, properties=rest)
