"""A training corpus from the documents table, in five stages.

Each stage gets what the one before it kept and returns documents again, the last one their token ids.
Between stages the rows are written as Parquet to the shared checkpoint folder, so a lost executor costs
no more than the stage that was running, and a named run that stopped goes on at that stage.

Defined results: a null or empty text is no toxicity, one group of near-duplicates with all others, no benchmark
passage, unchanged by pseudonyms, and no tokens. Repeated rows, and rows with one text, are near-duplicates, so
one of them stays: that with the smallest id, no id last. An empty table gives none. Further columns are kept by
all stages but the last, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, pii, piece, simhash, toxicity
from tidemark.llm.common import table
from tidemark.schemas import VERSION
from tidemark.session import ensure_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark contaminates, without the passages that some hold all the same."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced."""
    return pii.pseudonymise(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the byte at which each piece begins."""
    return piece.encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", decontaminate),
    ("pii", pseudonymise),
    ("sentencepiece", encode),
]

#: Trained weights and keyed permutations have no SQL; tests compare each stage with plain Python.
ORACLE_SQL: str | None = None


#: Names a run. A run of a name takes up what an earlier one of that name has finished over the same input, key
#: and stages; without a name, all is new. On a cluster that names no key, each application draws its own, so another
#: application starts anew.
RUN_SETTING = "spark.tidemark.pipeline.run"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what the one before it kept, written to the shared folder in between.

    A stage's folder goes when the next stage has been written, but for the last of them, which the result reads;
    that one is the caller's to delete (``corpus-*`` in the checkpoint folder)."""
    name = spark.conf.get(RUN_SETTING, "")
    name = f"{name}-{fingerprint(spark, sf_dir)}" if name else uuid.uuid4().hex
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{name}"
    paths = [f"{folder}/{k}-{name}" for k, (name, _) in enumerate(STAGES[:-1])]
    done = max((k for k, path in enumerate(paths) if _exists(spark, f"{path}/_SUCCESS")), default=-1)
    docs = table(spark, sf_dir, "documents") if done < 0 else spark.read.parquet(paths[done])
    for k in range(done + 1, len(paths)):
        STAGES[k][1](spark, docs, sf_dir).write.mode("overwrite").parquet(paths[k])
        docs = spark.read.parquet(paths[k])
        if k:
            _delete(spark, paths[k - 1])
    return STAGES[-1][1](spark, docs, sf_dir)


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """A digest of all that a run's result follows from: the input's files with their sizes and times, the key, the
    stages and the version of this package. A named run over anything else has another folder, and finds nothing to go on with."""
    said = [VERSION, hashlib.sha256(pii.key_of(spark)).hexdigest(), *(name for name, _ in STAGES)]
    for read in ("documents", "labels", "benchmark"):
        said += sorted(_files(spark, f"{sf_dir}/{read}.parquet"))
    return hashlib.sha256("\n".join(said).encode()).hexdigest()[:24]


def _files(spark: SparkSession, path: str) -> Iterator[str]:
    fs, place = _file_system(spark, path)
    found = fs.listFiles(place, True)
    while found.hasNext():
        status = found.next()
        yield f"{status.getPath()} {status.getLen()} {status.getModificationTime()}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _exists(spark: SparkSession, path: str) -> bool:
    fs, place = _file_system(spark, path)
    return fs.exists(place)


def _delete(spark: SparkSession, path: str) -> None:
    fs, place = _file_system(spark, path)
    fs.delete(place, True)
