"""Resumable judging (G3): a journal of replies, so that a prompt that was answered is not sent again.

The journal is a folder of Parquet waves ``(key, wave, reply, valid)``. A reply's key is the hash of the system prompt and the
judge prompt, so equal prompts are sent once, whatever rows they belong to, and a changed prompt counts as new. A wave
takes the keys that have no valid reply yet (an anti-join), sends them, and appends what comes back. Calls that fail and
replies that do not parse are sent again in the next wave; of a key's replies the newest valid one counts, else the newest.

Every task commits its own file when it is done (the output committer's second algorithm), so a job that fails
half-way keeps the replies of all tasks that had finished; files of unfinished tasks are never visible. What a failure can
have sent twice is bounded by ``task_rows`` a task. A task that is run twice adds a second reply to its keys, of which one counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
from inspect import signature

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatscope.operators.inference import batch_generate
from chatscope.operators.judge import SYSTEM_PROMPT, judge_prompt, parse_judge_reply
from chatscope.schemas import JUDGE_CRITERIA
from chatscope.session import materialize

SCHEMA = "key string, wave int, reply string, valid boolean"
WAVES = 3
TASK_ROWS = 10_000


def prompt_key(prompt: Column, system_prompt: str) -> Column:
    return F.sha2(F.concat(F.lit(system_prompt), F.lit("\u0001"), prompt), 256)


class JudgeJournal:
    """The journal in the folder ``path``; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _waves(self) -> list[int]:
        """All waves, finished or not."""
        sc = self.spark.sparkContext
        root = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(int(n.removeprefix("wave-")) for n in names if n.startswith("wave-"))

    def _folder(self, wave: int) -> str:
        return f"{self.path}/wave-{wave:08d}"

    def read(self) -> DataFrame:
        """Every reply that a task has committed."""
        found = [self._folder(w) for w in self._waves()]
        return self.spark.read.schema(SCHEMA).parquet(*found) if found else self.spark.createDataFrame([], SCHEMA)

    def replies(self) -> DataFrame:
        """``(key, reply, valid)``: the newest valid reply of each key, else its newest reply."""
        newest = F.struct("valid", "wave", "reply")
        return self.read().groupBy("key").agg(F.max(newest).alias("_m")).select("key", "_m.reply", "_m.valid")

    def append(self, replies: DataFrame) -> None:
        """Writes ``(key, reply, valid)`` as the next wave, task by task."""
        wave = max(self._waves(), default=-1) + 1
        replies.select("key", F.lit(wave).alias("wave"), "reply", "valid").write.option(
            "mapreduce.fileoutputcommitter.algorithm.version", "2").mode("append").parquet(self._folder(wave))


def resume(journal: JudgeJournal, df: DataFrame, make_judge, criteria: Sequence[str] = JUDGE_CRITERIA, keep: list[str] | None = None,
           batch_size: int = 16, system_prompt: str = SYSTEM_PROMPT, waves: int = WAVES, task_rows: int = TASK_ROWS) -> DataFrame:
    """As ``judge_batch``, through the journal: ``keep``, ``reply``, one column per criterion, ``failed``.

    ``make_judge`` is a model factory as in ``batch_generate``. A prompt without a valid reply is sent at most ``waves`` times in
    this call, in tasks of about ``task_rows`` prompts. Whoever calls again, after a failure or with more rows, goes on
    from the journal.
    """
    keep = keep or ["model", "sample_id"]
    if signature(make_judge).parameters:
        make_judge = partial(make_judge, system_prompt)
    prompt = judge_prompt("prompt", "reference", "prediction", criteria)
    rows = df.select(*keep, prompt.alias("judge_prompt")).withColumn("key", prompt_key(F.col("judge_prompt"), system_prompt))
    todo = rows.select("key", "judge_prompt")
    for _ in range(waves):
        # written, then counted and sent from there; what a later wave sends is among it
        todo = materialize(todo.join(journal.replies().where("valid"), "key", "left_anti").dropDuplicates(["key"]))
        n = todo.count()
        if not n:
            break
        got = batch_generate(todo.repartition(-(-n // task_rows), "key"), make_judge, "judge_prompt", "reply", ["key"], batch_size,
                             on_error="null")
        journal.append(parse_judge_reply(got, "reply", criteria).select("key", "reply", (~F.col("failed")).alias("valid")))
    # one reply a key; a prompt that many rows share makes a skewed join, which adaptive execution splits
    answered = rows.drop("judge_prompt").join(journal.replies().drop("valid"), "key", "left")
    return parse_judge_reply(answered, "reply", criteria).select(*keep, "reply", *criteria, "failed")
