"""Readers and writers: explicit schemas, product codes always as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchwright.functions.vectors import l2_norm, l2_normalize
from matchwright.operators.staging import fingerprint, read_note, write_note

RAW = T.StructType(
    [
        T.StructField("bb_id", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("name", "upc_raw", "brand_raw", "department")],
        *[T.StructField(c, T.StringType()) for c in ("description", "permanent_tags")],
        *[T.StructField(c, T.BooleanType()) for c in ("is_private_label", "is_fresh")],
        T.StructField("customer_item_id", T.StringType()),
    ]
)


def require_columns(df: DataFrame, columns: Sequence[str], name: str = "table") -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"{name} lacks the columns {missing}; it has {df.columns}")
    return df


def spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field holds a line break: then some line has an odd number of quotes."""
    odd = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    return bool(spark.read.text(path).where(odd).take(1))


def read_catalog(spark: SparkSession, path: str, schema: T.StructType = RAW, multi_line: bool | None = None) -> DataFrame:
    """A CSV catalog with a header. Columns are found by name; those that the file lacks are left out.

    Files are read in splits, unless fields with line breaks (looked for, if multi_line does not say) make a file one task.
    """
    many = spans_lines(spark, path) if multi_line is None else multi_line
    reader = spark.read.options(header=True, nullValue="", multiLine=many, escape='"')
    by_name = {f.name: f for f in schema}
    own = T.StructType([by_name.get(c.strip(), T.StructField(c.strip(), T.StringType())) for c in reader.csv(path).columns])
    return require_columns(reader.schema(own).csv(path), ["bb_id", "name"], path)


def load_data(spark: SparkSession, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    return read_catalog(spark, path_a), read_catalog(spark, path_b)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object for each row, null fields included."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_vectors(df: DataFrame, path: str, id_col: str, vector_col: str) -> None:
    """An index is a table of unit vectors, and beside it what its ids, dimension and norms were."""
    df.select(id_col, l2_normalize(F.col(vector_col)).alias(vector_col)).write.mode("overwrite").parquet(path)
    write_note(df.sparkSession, f"{path}/_index.json", _index_note(df.sparkSession.read.parquet(path), id_col, vector_col))


def _index_note(index: DataFrame, id_col: str, vector_col: str) -> dict[str, str]:
    size, norm = F.size(vector_col), l2_norm(F.col(vector_col))
    row = index.agg(F.min(size), F.max(size), F.min(norm), F.max(norm), F.count_if(F.col(vector_col).isNull())).first()
    shape = dict(zip(("least_size", "most_size"), ("" if v is None else str(v) for v in row[:2])))
    norms = dict(zip(("least_norm", "most_norm"), ("" if v is None else f"{v:.6f}" for v in row[2:4])))
    return {**fingerprint(index, id_col), **shape, **norms, "nulls": str(row[4])}


def read_vectors(spark: SparkSession, path: str, ids: DataFrame, id_col: str, vector_col: str = "embedding", dimension: int | None = None) -> DataFrame:
    """The index, refused unless it is as it was written and holds one unit vector of one dimension for each product."""
    found = spark.read.parquet(path)
    now, told = _index_note(found, id_col, vector_col), read_note(spark, f"{path}/_index.json")
    wanted = fingerprint(ids.select(id_col).distinct(), id_col)
    if told != now:
        raise ValueError(f"{path} is not the index that was written: {now} for {told}")
    if any(now[k] != v for k, v in wanted.items()):
        raise ValueError(f"{path} covers other products than asked for: {now['rows']} vectors for {wanted['rows']} products")
    if now["rows"] != "0":
        if now["nulls"] != "0" or now["least_size"] != now["most_size"] or (dimension and now["least_size"] != str(dimension)):
            raise ValueError(f"{path} holds vectors of {now['least_size']} to {now['most_size']} elements, {now['nulls']} nulls")
        if abs(float(now["least_norm"]) - 1) > 1e-3 or abs(float(now["most_norm"]) - 1) > 1e-3:
            raise ValueError(f"{path} holds vectors of norms from {now['least_norm']} to {now['most_norm']}")
    return found
