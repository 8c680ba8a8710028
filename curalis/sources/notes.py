"""Sources of notes: the registry's CSV file, and adapters that make notes of the test tables.

Internally a note has columns ``record_id, unit, reason, exam, stay``.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curalis.functions import values as V
from curalis.sources import split_csv

NAMES = {V.ID: "record_id", V.UNIT: "unit", V.REASON: "reason", V.EXAM: "exam", V.STAY: "stay"}
INNER = {"reason": V.REASON, "exam": V.EXAM, "stay": V.STAY}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, ``;`` between them, quoted fields over several lines, empty: null.  A file is read by
    as many tasks as its size asks for (``split_csv``)."""
    df = split_csv.read(spark, path)
    missing = [c for c in NAMES if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def to_notes(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").alias(n) for c, n in NAMES.items()))


def read_loose_csv(spark: SparkSession, path: str) -> DataFrame:
    """``read_csv`` for the list miners: what usually stands for a missing value is null, in every column."""
    df = read_csv(spark, path)
    return df.select(*(F.when(~F.col(f"`{c}`").isin(*V.LOOSE_NULLS), F.col(f"`{c}`")).alias(c) for c in df.columns))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the store it names, as Spark sees it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def write_text(spark: SparkSession, path: str, content: str) -> None:
    """A small file made by the driver, in whatever store the path names."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()


def write_csv(notes: DataFrame, path: str) -> None:
    """Notes as a file that ``read_csv`` reads."""
    named = notes.select(*(F.col(n).alias(c) for c, n in NAMES.items()))
    named.write.mode("overwrite").option("sep", ";").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def discover(spark: SparkSession, *paths: str) -> str:
    """The first path that exists, by default of the usual places."""
    for path in paths or V.DEFAULT_PATHS:
        if exists(spark, path):
            return path
    raise FileNotFoundError(", ".join(paths or V.DEFAULT_PATHS))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text, in whatever store the path names."""
    return "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


#: Files up to this size are hashed as one value; larger ones as a stream of lines.
WHOLE_BYTES = 64 << 20


def sha256(spark: SparkSession, path: str) -> str:
    """Hash of a file; of a folder, of the hashes of its files by name.  Files are hashed by tasks, many at a time, and the driver
    gets digests only.  One file's hash is one chain over its bytes: a large file is sorted by place in the task that hashes it
    as a stream, so its lines and not the file must fit in memory."""
    files = spark.read.format("binaryFile").load(path)
    sizes = {r["path"]: r["length"] for r in files.select("path", "length").collect()}
    small = files.where(F.col("length") <= WHOLE_BYTES).select("path", F.sha2("content", 256).alias("digest"))
    found = {r["path"]: r["digest"] for r in small.collect()} if any(n <= WHOLE_BYTES for n in sizes.values()) else {}
    large = [p for p in sizes if p not in found]
    if large:
        text = spark.read.option("lineSep", "\n").text(large)
        lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"), F.col("value").cast("binary").alias("value"))

        def chain(batches):
            now, digest, size, done = None, None, 0, 0

            def row():
                if done < size:  # the line end that the last line has, or has not
                    digest.update(b"\n")
                return pa.RecordBatch.from_pylist([{"file": now, "digest": digest.hexdigest()}])

            for batch in batches:
                for file, n, line in zip(*(batch.column(i).to_pylist() for i in (0, 1, 4)), strict=True):
                    if file != now:
                        if now is not None:
                            yield row()
                        now, digest, size, done = file, hashlib.sha256(), n, 0
                    else:
                        digest.update(b"\n")
                        done += 1
                    digest.update(line)
                    done += len(line)
            if now is not None:
                yield row()

        ordered = lines.repartition("file").sortWithinPartitions("file", "start", "id")
        found |= {r["file"]: r["digest"] for r in ordered.mapInArrow(chain, "file string, digest string").collect()}
    if len(sizes) == 1 and next(iter(sizes)).rstrip("/").endswith(path.rstrip("/").rpartition("/")[2]):
        return next(iter(found.values()))
    return hashlib.sha256("".join(found[p] for p in sorted(found)).encode()).hexdigest()


def read_lists(path: str | None = None) -> dict[str, list[str]]:
    """Word lists of a YAML file in any store, or the default ones; a list that is missing is empty."""
    if path is None:
        return V.LISTS
    found = yaml.safe_load(read_text(SparkSession.active(), path)) or {}
    return {k: [str(x) for x in found.get(k) or []] for k in V.LISTS}


def read_abbreviations(path: str | None = None) -> dict[str, str]:
    if path is None:
        return V.ABBREVIATIONS
    found = yaml.safe_load(read_text(SparkSession.active(), path)) or {}
    return {str(k).lower(): str(v) for k, v in (found.get("abreviaturas") or {}).items()}


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt anew by a key, but only where the scan of a small file has fewer partitions than there are cores: the
    expressions on notes cost far more than moving such a file, and larger ones are not moved."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter B: the first two lines of a document are two fields, all further lines the third."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), "doc_id")
    line = lambda i: F.nullif(F.split_part("text", F.lit("\n"), F.lit(i)), F.lit(""))
    rest = F.nullif(F.regexp_extract("text", r"^[^\n]*\n[^\n]*\n([\s\S]*)$", 1), F.lit(""))
    return docs.select(F.col("doc_id").cast("string").alias("record_id"), F.lit(None).cast(T.StringType()).alias("unit"), line(1).alias("reason"), line(2).alias("exam"), rest.alias("stay"))


#: Adapter A: a templated note for each order, in SQL that Spark and DuckDB read alike; {day} is a date format and
#: {orders} the table.  Every rewrite rule finds something in it, and something that it must leave alone.
TEMPLATE = """
SELECT CAST(o_orderkey AS STRING) AS record_id,
  CASE WHEN o_orderkey % 7 = 0 THEN 'Meses' WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'Años' END AS unit,
  CASE o_orderkey % 9 WHEN 0 THEN 'Me cai de la moto' WHEN 1 THEN 'Herida por arma de fuego, hpaf' WHEN 2 THEN 'Me golpearon con un palo'
    WHEN 3 THEN 'Quemadura en mano derecha' WHEN 4 THEN NULL WHEN 5 THEN 'CE en ojo derecho, signo de bolivar' WHEN 6 THEN 'Lo mordió un canino en cali'
    WHEN 7 THEN 'Me pegaron un tiro hace 2 años' ELSE 'Me cortaron con vidrio: CE, CE' END AS reason,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN rpad('Dolor en torax y abdomen ', 490, 'x') ELSE
    concat('Paciente de ', CAST(o_custkey % 101 AS STRING), CASE o_orderkey % 6 WHEN 0 THEN ' meses' WHEN 1 THEN ' dias' ELSE ' años' END, ', ingresa el ', {day}, ' a las 14:35. Atendido por ',
      CASE o_orderkey % 3 WHEN 0 THEN 'dr. moncada' WHEN 1 THEN 'dra. perez' ELSE 'el servicio' END, ' en ',
      CASE o_orderkey % 10 WHEN 0 THEN 'hospital san rafael' WHEN 1 THEN 'clinica la aurora' WHEN 2 THEN 'hospital local' WHEN 3 THEN 'urgencias'
        WHEN 4 THEN 'hospital mario correa' WHEN 5 THEN 'rayito de sol' WHEN 6 THEN 'fundacion san martin' WHEN 7 THEN 'HUC' WHEN 8 THEN 'ESE norte' ELSE 'hospital universitario del valle' END,
      ', remitido de ', CASE o_orderkey % 2 WHEN 0 THEN 'palmira' ELSE 'otra sede' END, '. fx de codo, TAC sin lesion, fx previa') END AS exam,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 'Se hospitaliza y queda con' ELSE
    concat('Documento 1', CAST(10000000 + o_custkey AS STRING), ' correo a', CAST(o_custkey AS STRING), '@mail.com. ',
      CASE o_orderkey % 8 WHEN 0 THEN concat('Tel 310 555 ', CAST(1000 + o_custkey % 9000 AS STRING), ' de la madre')
        WHEN 1 THEN concat('Ingreso ', CAST(4000000 + o_orderkey % 900000 AS STRING), ' abierto') WHEN 2 THEN 'Cirugia el 5 de marzo de 2019, control' WHEN 3 THEN 'Trauma en agosto de 2018 sin secuelas'
        WHEN 4 THEN concat('Operado en ', CAST(1990 + o_custkey % 30 AS STRING), ' de apendice') WHEN 5 THEN concat('Hijo de ', CAST(1 + o_custkey % 17 AS STRING), ' años de edad acompaña')
        WHEN 6 THEN 'Hace 15 años de edad escolar, TA 120/80, 2000 cc' ELSE 'Llevado a cirugía, uci' END,
      '. Se da salida con signos de alarma') END AS stay
FROM {orders}
"""


def from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey")
    return spark.sql(TEMPLATE.format(day="date_format(o_orderdate, 'dd/MM/yyyy')", orders="{orders}"), orders=orders)


ORDERS_SQL = TEMPLATE.format(day="strftime(o_orderdate, '%d/%m/%Y')", orders="orders")
