"""Readers: validated CSV, globs, JSON caches, ontologies, paged sources."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from florispark.functions.text import blank_to_null, strip_ws
from florispark.sources.versions import VersionedTable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def csv_validated(spark: SparkSession, path: str, columns: dict[str, str], keep_blank: Sequence[str] = (), multiline: bool = True) -> DataFrame:
    """A CSV with header whose columns are checked, renamed and stripped; blanks are null but in keep_blank.

    A byte-order mark before the first header is allowed.  Missing columns are an error.
    Files without line breaks in quotes can be split into tasks: multiline=False.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', multiLine=multiline)
    raw = raw.toDF(*(c.lstrip("\ufeff").strip() for c in raw.columns))
    missing = sorted(set(columns) - set(raw.columns))
    if missing:
        raise ValueError(f"{path} lacks columns: {', '.join(missing)}")
    return raw.select(*((F.coalesce(strip_ws(F.col(f"`{a}`")), F.lit("")) if b in keep_blank else blank_to_null(F.col(f"`{a}`"))).alias(b) for a, b in columns.items()))


def csv_strings(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Every column a string, blanks null; a glob is many files, gzip is read as such and dealt out again."""
    raw = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', multiLine=multiline)
    out = raw.select(*(F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns))
    return out.repartition(spark.sparkContext.defaultParallelism) if path.endswith(".gz") else out


def numbered(df: DataFrame, keys: Sequence[str], name: str = "entry_seq") -> DataFrame:
    """A number from 1 within keys, in order of file and line."""
    from pyspark.sql import Window

    held = df.withColumn("_file", F.input_file_name()).withColumn("_line", F.monotonically_increasing_id())
    return held.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy("_file", "_line"))).drop("_file", "_line")


def json_cache(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(name, record) rows of JSON objects of records by name: an object for a file, or, in folders of keys, one on each line; value is the record's DDL type."""
    text = spark.read.text(path, wholetext=path.endswith(".json"))
    return text.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("name", "record"))


def vocabulary(spark: SparkSession, path: str, key: str, value: str | None = None) -> DataFrame:
    """(token[, value]) of a vocabulary file; no file is an empty one."""
    from pyspark.errors import AnalysisException

    try:
        df = csv_strings(spark, path)
    except AnalysisException:
        return spark.createDataFrame([], "token string, value string" if value else "token string")
    return df.select(F.col(key).alias("token"), *([F.col(value).alias("value")] if value else [])).where("token is not null")


def obo(spark: SparkSession, path: str) -> DataFrame:
    """(id, name, definition, parents, roles, structure_key) of an ontology's live terms; gzip by its ending."""
    stanzas = spark.read.text(path, lineSep="\n[Term]\n").where(F.col("value").rlike("(?m)^id: "))
    # other kinds of stanza may follow the last term
    text = F.regexp_replace("value", r"(?s)\n\[(?!Term).*$", "")
    one = lambda tag: F.nullif(F.regexp_extract(text, rf"(?m)^{tag}: (.*)$", 1), F.lit(""))
    many = lambda pattern: F.regexp_extract_all(text, F.lit(pattern), 1)
    return stanzas.where(~F.col("value").rlike("(?m)^is_obsolete: true") & ~F.col("value").rlike(r"^format-version:")).select(
        one("id").alias("id"),
        one("name").alias("name"),
        F.nullif(F.regexp_extract(text, r'(?m)^def: "((?:[^"\\]|\\.)*)"', 1), F.lit("")).alias("definition"),
        many(r"(?m)^is_a: (\S+)").alias("parents"),
        many(r"(?m)^relationship: (?:RO:0000087|has_role) (\S+)").alias("roles"),
        F.nullif(F.regexp_extract(text, r'(?m)^property_value: \S*inchikey "?([A-Z-]+)', 1), F.lit("")).alias("structure_key"),
    )


class Buckets(InputPartition):
    """Several buckets that one task reads."""

    def __init__(self, buckets: list["Bucket"]):
        self.buckets = buckets


class Bucket(InputPartition):
    def __init__(self, prefix: str, total: int):
        self.prefix, self.total = prefix, total


def client_of(clients: dict[str, Callable], options) -> Callable[[], object]:
    return partial(clients[options["client"]], **json.loads(options.get("arguments", "{}")))


class PagedSource(DataSource):
    """A paged search API as a source: id prefixes are split until each is below the API's paging depth; one partition each, or, with the option rows_per_task, neighbours in one.

    The option client names one of clients, which makes an object with count(prefix) -> int and
    page(prefix, number, size) -> rows; the option arguments is a JSON object of what it is made with.
    """

    clients: dict[str, Callable[[], object]] = {}

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return self.options.get("schema", "id string, payload string")

    def reader(self, schema) -> "PagedReader":
        return PagedReader(client_of(self.clients, self.options), int(self.options.get("most", 10_000)), int(self.options.get("size", 200)), self.options.get("alphabet", "0123456789"), int(self.options.get("rows_per_task", 0)))


class PagedReader(DataSourceReader):
    def __init__(self, client, most: int, size: int, alphabet: str, rows_per_task: int = 0):
        self.client, self.most, self.size, self.alphabet, self.rows_per_task = client, most, size, alphabet, rows_per_task

    def partitions(self) -> list[InputPartition]:
        buckets = self.buckets()
        if not self.rows_per_task:
            return buckets
        dealt, rows = [], self.rows_per_task
        for b in buckets:
            if rows + b.total > self.rows_per_task:
                dealt.append([])
                rows = 0
            dealt[-1].append(b)
            rows += b.total
        return [Buckets(x) for x in dealt]

    def buckets(self) -> list[Bucket]:
        api, todo, out = self.client(), list(self.alphabet), []
        while todo:
            prefix = todo.pop()
            n = api.count(prefix)
            if n > self.most:
                todo += [prefix + x for x in self.alphabet]
            elif n:
                out.append(Bucket(prefix, n))
        return sorted(out, key=lambda b: b.prefix)

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        api = self.client()
        for bucket in partition.buckets if isinstance(partition, Buckets) else [partition]:
            yield from self._bucket(api, bucket)

    def _bucket(self, api, partition: Bucket) -> Iterator[tuple]:
        seen, number = 0, 0
        while seen < partition.total:
            rows = list(api.page(partition.prefix, number, self.size))
            if not rows:
                raise RuntimeError(f"{partition.prefix}: {seen} rows of {partition.total}")
            yield from rows
            seen, number = seen + len(rows), number + 1


def reconciled(df: DataFrame, key: str, expected: int) -> DataFrame:
    """Distinct rows by key; an error if rows in all aren't as many as the source says."""
    total = df.count()
    if total != expected:
        raise ValueError(f"{total} rows, {expected} expected")
    return df.dropDuplicates([key])


def enrich(keys: DataFrame, cache: DataFrame, key: str, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The cache with what fetch() returns for keys that it lacks; misses are rows too and aren't asked again."""
    new = keys.select(key).distinct().join(cache.select(key), key, "left_anti")
    return cache.unionByName(fetch(new))


def fetch_batches(keys: DataFrame, key: str, client: Callable[[], object], size: int = 100, tries: int = 4, pause: float = 0.05) -> DataFrame:
    """(key, found, payload): records of a keyed API that takes up to `size` keys at once; tasks ask in parallel.

    client() gives an object with fetch(list of keys) -> {key: payload}, or None for a transient
    failure, which is asked again after a growing pause and is an error after `tries`; a key that isn't in
    the answer is missing, which is a result.  Where it has retry(key), missing keys are asked once more
    by it, one by one, with whatever hint it adds; its answer has the same form, {} for a miss that lasts.
    """

    def asked(ask: Callable[[], dict | None], what) -> dict:
        for n in range(tries):
            if (got := ask()) is not None:
                return got
            time.sleep(pause * 2**n)
        raise RuntimeError(f"{what}: no answer after {tries} tries")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        api = client()
        again = getattr(api, "retry", lambda k: {})
        for pdf in batches:
            for at in range(0, len(pdf), size):
                part = pdf[key].iloc[at : at + size].tolist()
                got = asked(lambda part=part: api.fetch(part), part[0])
                values = [got[k] if k in got else asked(lambda k=k: again(k), k).get(k) for k in part]
                yield pd.DataFrame({key: part, "found": [v is not None for v in values], "payload": values})

    kind = keys.schema[key].dataType.simpleString()
    return keys.select(key).where(F.col(key).isNotNull()).distinct().mapInPandas(run, f"`{key}` {kind}, found boolean, payload string")


def group_bindings(bindings: DataFrame, key: str, kind: str, value: str, label: str | None = None) -> DataFrame:
    """(key, values, label): one row for each key from one row for each combination, as a query endpoint gives them: distinct values by kind, in order."""
    per = bindings.where(F.col(value).isNotNull()).groupBy(key, kind).agg(F.array_sort(F.collect_set(value)).alias("v"))
    lists = per.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(kind, "v")))).alias("values"))
    if label is None:
        return lists
    return bindings.groupBy(key).agg(F.min(label).alias("label")).join(lists, key, "left")


def snapshot(spark: SparkSession, path: str, fetch: Callable[[], DataFrame], days: float = 7, optional: bool = False) -> DataFrame | None:
    """A remote table kept at path: as it is there for some days, then fetched again; if that fails, before or while it runs, the old one, or None where it is optional.

    Each copy is a version of its own, so the old one is there until the new one is whole.
    """
    kept = VersionedTable(spark, path)
    made = kept.versions()
    if made and time.time() - made[max(made)] < days * 86400:
        return kept.read()
    try:
        kept.replace(fetch())
    except Exception:
        if not made and not optional:
            raise
        return kept.read() if made else None
    return kept.read()


def present(spark: SparkSession, names: Sequence[str]) -> dict[str, bool]:
    """Which tables or views the catalog has."""
    return {n: spark.catalog.tableExists(n) for n in names}


def normalise_inventory(df: DataFrame, columns: dict[str, str], lists: Sequence[str] = (), dates: Sequence[str] = (), keep_blank: Sequence[str] = ()) -> DataFrame:
    """A newer inventory in the older one's columns: renamed, blanks null but in keep_blank, lists split at '|', dates parsed."""
    from florispark.functions.text import split_list, to_date_dmy

    out = []
    for new, old in columns.items():
        c = F.col(new).cast("string")
        if old in lists:
            out.append(split_list(F.coalesce(c, F.lit("")), r"\|").alias(old))
        elif old in dates:
            out.append(to_date_dmy(c).alias(old))
        else:
            out.append((F.coalesce(strip_ws(c), F.lit("")) if old in keep_blank else blank_to_null(c)).alias(old))
    return df.select(*out)
