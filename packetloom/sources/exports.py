"""JSON bodies, compressed JSON, CSV with a fixed header, per-session CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.functions.payloads import join_samples

# File headers and file kinds.
PRESSURE_HEADER = ["timestamp_python", "timestamp", "counter", "read", "trigger", "pressure_data"]
IMU_HEADER = ["timestamp_python", "ts_board", "packet_counter", "imu_data"]
SFLP_HEADER = ["timestamp_python", "ts_board", "packet_counter", "sflp_data"]
FILE_KINDS = ("pressure", "pressure_shoe", "IMU", "SFLP")


def json_body(value):
    """``{"data": value}`` of a scalar or list column."""
    return F.to_json(F.struct(F.col(value).alias("data")))


def write_compressed_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """Rows as gzip-compressed JSON lines, one file per partition."""
    df.write.mode(mode).option("compression", "gzip").json(path)


def with_header(df: DataFrame, header) -> DataFrame:
    """Exactly the header's columns: missing ones null, others dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in header])


def session_columns(df: DataFrame, kind: str, address: str, start_ms: str) -> DataFrame:
    """Folder and file name of a session file as columns.

    ``sessions/{address}/{yyyy-MM-dd_HH-mm-ss}/{kind}_{address}_{ms}.csv``
    """
    if kind not in FILE_KINDS:
        raise ValueError(f"unknown data type {kind!r}")
    plain = F.regexp_replace(F.col(address), ":", "")
    begin = F.expr(f"timestampadd(MILLISECOND, `{start_ms}`, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    started = F.date_format(begin, "yyyy-MM-dd_HH-mm-ss")
    name = F.concat(F.lit(kind + "_"), plain, F.lit("_"), F.col(start_ms).cast("string"), F.lit(".csv"))
    return df.withColumns(
        {
            "session_address": plain, "session_start": started,
            "session_file": F.concat_ws("/", F.lit("sessions"), plain, started, name),
        }
    )


def pressure_csv_rows(packets: DataFrame) -> DataFrame:
    """Packets with the CSV's columns; the samples as one ``"a, b"`` text."""
    return packets.withColumn("pressure_data", join_samples("pressure"))


def write_session_csv(df: DataFrame, path: str, header, by=("session_address", "session_start"),
                      mode: str = "append") -> None:
    """CSV files with a header, in one folder per session.

    Spark writes a folder of part files per session; a long session is many
    files written side by side. An empty frame writes no file.
    """
    cols = [*by, *[c for c in header if c not in by]]
    out = with_header(df, cols)
    out.write.mode(mode).option("header", True).partitionBy(*by).csv(path)


def read_session_csv(spark, path: str, header, by=("session_address", "session_start")) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in [*header, *by])
    return spark.read.schema(schema).option("header", True).csv(path)
