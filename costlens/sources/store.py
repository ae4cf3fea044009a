"""Tables and small documents of a tenant; missing ones are empty."""

from __future__ import annotations

import csv
import io
import json
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.masks import Terms

try:
    import yaml
except ImportError:  # an optional library
    yaml = None

# Small default term lists.
DEFAULTS = {"exclusions": "vm sql aks db adf nsg vnet disk storage", "environments": "prod dev test uat qa stage staging preprod", "regions": "weu neu eus wus northeurope westeurope eastus westus"}


def scratch(spark: SparkSession) -> str:
    """A folder of this application in the one that driver and executors share. A local session that names none has one of
    its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="costlens-"))
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder.rstrip('/')}/costlens-{spark.sparkContext.applicationId}"


def sweep(spark: SparkSession) -> bool:
    """Deletes all tables that the application's operators wrote for themselves; frames that still read them fail."""
    return remove(spark, scratch(spark))


def held(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written in the shared folder and read back: later plans start from the table, not from what made it."""
    path = f"{scratch(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Deletes the files of a table that ``held`` wrote and that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
        remove(frame.sparkSession, path)


def month_path(base: str, tenant: str, stem: str, year: int, month: str, phase: str, suffix: str) -> str:
    return f"{base.rstrip('/')}/{tenant}/audit/{stem}.{year}_{month}.{phase}.{suffix}"


def read_table(spark: SparkSession, path: str, schema: T.StructType | str, kind: str = "parquet") -> DataFrame:
    """A table, or an empty one of ``schema`` if there is none."""
    options = {"header": True, "escape": '"', "multiLine": True} if kind == "csv" else {}
    try:
        return spark.read.format(kind).schema(schema).options(**options).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def write_table(frame: DataFrame, path: str, kind: str = "parquet", mode: str = "overwrite") -> None:
    options = {"header": True, "escape": '"'} if kind == "csv" else {}
    frame.write.format(kind).mode(mode).options(**options).save(path)


def read_document(spark: SparkSession, path: str) -> dict | list:
    """A small JSON document in any store; missing or invalid ones are empty."""
    try:
        return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))
    except (AnalysisException, ValueError):
        return {}


def _opened(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text as one file, in any store that Hadoop knows."""
    store, place = _opened(spark, path)
    out = store.create(place, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    store, place = _opened(spark, path)
    if not store.exists(place):
        return None
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _opened(spark, path)
    return store.exists(place)


def make_dirs(spark: SparkSession, path: str) -> None:
    store, place = _opened(spark, path)
    store.mkdirs(place)


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes a file or folder; False if there was none."""
    store, place = _opened(spark, path)
    return store.delete(place, True)


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Copies a file or folder, between stores too."""
    (a, x), (b, y) = _opened(spark, source), _opened(spark, target)
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(a, x, b, y, False, True, spark.sparkContext._jsc.hadoopConfiguration())


def write_header(spark: SparkSession, columns: list[str], path: str) -> None:
    """A CSV file of a header alone."""
    out = io.StringIO()
    csv.writer(out).writerow(columns)
    write_text(spark, out.getvalue(), path)


def read_yaml(spark: SparkSession, path: str) -> dict | list:
    """A small YAML document; missing or invalid ones are empty. Without the yaml library only its JSON form is read."""
    text = read_text(spark, path)
    if text is None:
        return {}
    try:
        return (yaml.safe_load(text) if yaml else json.loads(text)) or {}
    except Exception:  # noqa: BLE001  the parsers raise errors of their own
        return {}


def write_yaml(spark: SparkSession, document: dict | list, path: str) -> None:
    write_text(spark, yaml.dump(document, default_flow_style=False, sort_keys=False) if yaml else json.dumps(document, indent=1), path)


#: Fixed value: the key of the list.
KNOWN = "known_entities"


def known_entities(spark: SparkSession, path: str) -> list[dict]:
    """Entities that a tenant's YAML document lists; items that are no objects are passed over."""
    document = read_yaml(spark, path)
    listed = document.get(KNOWN, []) if isinstance(document, dict) else []
    return [item for item in listed if isinstance(item, dict)] if isinstance(listed, list) else []


def all_terms(chunks: list[str], terms: Terms) -> list[str]:
    """Protected chunks and a tenant's terms in lower case, each once, the longest first and equally long ones by name."""
    every = {str(t).lower() for t in [*chunks, *terms.tech, *terms.env, *terms.reg]}
    return sorted(every, key=lambda t: (-len(t), t))


def write_document(spark: SparkSession, document: dict | list, path: str) -> None:
    spark.createDataFrame([(json.dumps(document, indent=1, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_terms(spark: SparkSession, folder: str) -> Terms:
    """Terms of a tenant's folder: files of words parted by blanks; a missing file has none."""

    def words(name: str) -> set[str]:
        try:
            return {w for r in spark.read.text(f"{folder}/{name}.txt").collect() for w in r[0].split()}
        except AnalysisException:
            return set()

    return Terms.of(words("exclusions"), words("environments"), words("regions"))


def init_tenant(spark: SparkSession, folder: str) -> None:
    """Writes the default term lists where there are none."""
    for name, listed in DEFAULTS.items():
        try:
            spark.read.text(f"{folder}/{name}.txt").limit(1).collect()
        except AnalysisException:
            spark.createDataFrame([(w,) for w in listed.split()], "value string").coalesce(1).write.text(f"{folder}/{name}.txt")


def master_document(grouped: DataFrame, distinct: DataFrame, year: int, month: str, generated: str) -> dict:
    """The master list of entities as one document; its size follows the number of entities, which is capped upstream."""
    rows = lambda f, key: [r.asDict(recursive=True) for r in f.orderBy(key).collect()]
    return {"snapshot_id": f"{year}_{month}", "generation_date": generated, "method": "tfidf_char_3_5_cosine", "thresholds": {"duplicate": 0.92, "related": 0.8}, "linking": "reciprocal_top_k_5", "groups": rows(grouped, "canonical"), "distinct_entities": rows(distinct, "entity_name")}
