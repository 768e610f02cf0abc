"""Input tables and stored stages."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.session import checkpoint_dir, materialise


#: Rows that a function sees at a time, so that few texts are Python objects at once.
SLICE_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: the lineage ends there."""
    return materialise(df, f"llm-{name}")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/roadpulse/llm-{name}-{uuid.uuid4().hex}"


def doc_texts(docs: DataFrame, column: str = "text") -> DataFrame:
    """doc_id as it is and the whole text, null as empty; other columns stay behind."""
    return docs.select("doc_id", F.coalesce(F.col(column).cast("string"), F.lit("")).alias("text"))


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` maps one Arrow record batch to a dict of columns, batch after batch, within its task."""
    fields = [(f.name, _arrow(f.dataType)) for f in T._parse_datatype_string(schema).fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                for columns in fn(batch.slice(at, SLICE_ROWS)):
                    yield pa.RecordBatch.from_arrays(
                        [columns[n] if isinstance(columns[n], pa.Array) else pa.array(columns[n], t) for n, t in fields],
                        [n for n, _ in fields])
    return df.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)
