"""Versioned output: a version is written aside in full, checked, and only then named by a pointer table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.operators.gates import require_none


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def publish(df: DataFrame, root: str, version: int, check: Callable[[DataFrame], DataFrame] | None = None, partition: list[str] | None = None) -> None:
    """Write df aside, check it as written, then name it by a pointer file. A failed check leaves the old version in force.

    The pointer is written aside too and renamed into place, which fails where the version is taken: of two writers one raises, and neither
    touches the other's data.
    """
    spark = df.sparkSession
    name = f"v={version}-{uuid.uuid4().hex}"
    target = f"{root}/data/{name}"
    (df.write.partitionBy(*partition) if partition else df.write).parquet(target)
    if check is not None:
        require_none(check(spark.read.parquet(target)))
    fs, aside = _file_system(spark, f"{root}/pointer/.{name}")
    out = fs.create(aside, False)
    out.write(bytearray(name.encode()))
    out.close()
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{root}/pointer/{version}")
    none = spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(aside, place, none)
    except Py4JJavaError as error:
        raise FileExistsError(f"version {version} is published already") from error


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """df as a table of the folder, read back: what reads it does not compute it again, and a lost executor loses nothing of it."""
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def current_version(spark: SparkSession, root: str) -> int | None:
    """The largest published version, from the names of the pointer files alone."""
    fs, at = _file_system(spark, f"{root}/pointer")
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return max((int(n) for n in names if n.isdigit()), default=None)


def current(spark: SparkSession, root: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(root)
    return _version(spark, root, version)


def _version(spark: SparkSession, root: str, version: int) -> DataFrame:
    fs, at = _file_system(spark, f"{root}/pointer/{version}")
    file = fs.open(at)
    name = bytes(file.readAllBytes()).decode()
    file.close()
    return spark.read.parquet(f"{root}/data/{name}")


def reused(old: DataFrame, new: DataFrame, key: str, content: str, place: str) -> DataFrame:
    """new with `from`: where a row of the same key and content lies already (old's `place`), or null if it has to be written. Nothing is copied."""
    before = old.select(F.col(key).alias("_k"), F.col(content).alias("_c"), F.col(place).alias("from"))
    return new.join(before, (F.col(key) == F.col("_k")) & (F.col(content) == F.col("_c")), "left").drop("_k", "_c")


def split_write(df: DataFrame, reason: str, accepted: str, quarantine: str) -> None:
    """Rows without a reason to one table, the others to another, by reason; nothing is lost."""
    df.filter(F.col(reason).isNull()).drop(reason).write.mode("overwrite").parquet(accepted)
    df.filter(F.col(reason).isNotNull()).write.mode("overwrite").partitionBy(reason).parquet(quarantine)


def stages_to_run(stages: list[str], done: list[tuple[str, str]], config: str, exists: Callable[[str], bool]) -> list[str]:
    """Stages after the completed ones. done lists (stage, config) in order; it must be a prefix of stages, made with the same
    config, and every output must still be there."""
    if [s for s, _ in done] != stages[: len(done)]:
        raise ValueError("the completed stages are no prefix of the plan")
    if any(c != config for _, c in done):
        raise ValueError("a completed stage was made with another configuration")
    if missing := [s for s, _ in done if not exists(s)]:
        raise ValueError(f"outputs are missing: {missing}")
    return stages[len(done) :]


Stage = tuple[str, Callable[[DataFrame | None], DataFrame]]


def run_stages(spark: SparkSession, root: str, stages: list[Stage], config: str, crash_before_entry: str | None = None) -> dict[str, DataFrame]:
    """Run the stages that a log does not name yet, in order, each on its predecessor's output (the first on None), and return all outputs.

    A stage's output is written whole first and its entry in the log then, as a version of its own that names where the output lies; so a run that dies
    between the two does the stage again, elsewhere, and never reads half an output. A log that was made with another configuration raises, and so does
    one whose outputs are gone. crash_before_entry names a stage to die at, for tests.
    """
    log, done, outputs = f"{root}/log", [], {}
    for k in range(current_version(spark, log) or 0):
        entry = _version(spark, log, k + 1).first()
        done.append((entry["stage"], entry["config"]))
        outputs[entry["stage"]] = entry["output"]

    def exists(name: str) -> bool:
        fs, at = _file_system(spark, outputs[name] + "/_SUCCESS")
        return fs.exists(at)

    names = [name for name, _ in stages]
    todo = stages_to_run(names, done, config, exists)
    for name, run in stages[len(names) - len(todo) :]:
        k = names.index(name)
        before = spark.read.parquet(outputs[names[k - 1]]) if k else None
        outputs[name] = f"{root}/stage/{name}-{uuid.uuid4().hex}"
        run(before).write.parquet(outputs[name])
        if name == crash_before_entry:
            raise InterruptedError(name)
        publish(spark.createDataFrame([(name, config, outputs[name])], "stage string, config string, output string"), log, k + 1)
    return {name: spark.read.parquet(outputs[name]) for name in names}
