"""Batch inference through a user-supplied model function.

The model is a factory ``make_fn() -> fn`` where ``fn(pd.Series[str]) ->
pd.Series[str]``. ``mapInPandas`` streams Arrow batches through it; the
factory runs once per Python worker (cached at module level, reused across
tasks because Spark reuses Python workers), never per row. Key columns are
carried through unchanged, so outputs are joined back by key, not by position.
No network client is shipped: judges and models are whatever the caller passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ModelFn = Callable[[pd.Series], pd.Series]

_WORKER_MODELS: dict = {}


def _model_for(make_fn: Callable[[], ModelFn]) -> ModelFn:
    """One model instance per Python worker process and factory.

    Each task unpickles its own copy of the factory, so the object id changes
    from task to task; the cache key is a digest of the pickled factory, which
    is the same for every task of one job and differs between closures.
    """
    import hashlib

    from pyspark import cloudpickle
    key = hashlib.sha1(cloudpickle.dumps(make_fn)).hexdigest()
    fn = _WORKER_MODELS.get(key)
    if fn is None:
        fn = _WORKER_MODELS[key] = make_fn()
    return fn


def batch_generate(df: DataFrame, make_fn: Callable[[], ModelFn], input_col: str = "prompt",
                   output_col: str = "output", keep: list[str] | None = None, batch_size: int = 64,
                   on_error: str = "raise") -> DataFrame:
    """G1: one output string per input row; ``keep`` columns pass through.

    ``batch_size`` bounds the rows handed to the model at once (Arrow batches
    are re-chunked). With ``on_error='null'`` the rows of a failing batch are
    tried again one by one, and only those that fail alone get a NULL output
    (the judge path scores those as failures), so the result does not depend
    on ``batch_size``.
    """
    keep = list(keep or [c for c in df.columns if c != input_col])
    fields = [f for f in df.schema.fields if f.name in keep]
    schema = T.StructType(fields + [T.StructField(output_col, T.StringType(), True)])
    cols = keep + [input_col]

    def alone(fn: ModelFn, value: str | None) -> str | None:
        try:
            return pd.Series(fn(pd.Series([value], dtype="object")), dtype="object").iloc[0]
        except Exception:  # noqa: BLE001 - whatever the caller's model raises for this row
            return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = _model_for(make_fn)
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                part = pdf.iloc[start:start + batch_size]
                try:
                    out = pd.Series(fn(part[input_col].reset_index(drop=True)), dtype="object")
                except Exception:
                    if on_error != "null":
                        raise
                    out = pd.Series([alone(fn, v) for v in part[input_col]], dtype="object")
                res = part[keep].reset_index(drop=True).copy()
                res[output_col] = out.values
                yield res

    return df.select(*cols).mapInPandas(run, schema)


# ---------------------------------------------------------------- stubs
# Deterministic stand-ins used by the tests and registered queries; each is
# expressible in SQL so its results can be checked against DuckDB.

def make_echo_tool_model() -> ModelFn:
    """Reads the last user turn ``<event> for user <id>`` and emits one call."""
    def fn(prompts: pd.Series) -> pd.Series:
        m = prompts.str.extract(r"(?s).*<start_of_turn>user\n(\S+) for user (\S+?)<end_of_turn>", expand=True)
        calls = ("<start_function_call>call:" + m[0] + "{user:<escape>" + m[1] + "<escape>}<end_function_call>")
        return calls.where(m[0].notna(), "I can not help with that.<end_of_turn>")
    return fn


def make_length_judge() -> ModelFn:
    """A judge reply from string lengths of the judge prompt's sections."""
    def fn(prompts: pd.Series) -> pd.Series:
        parts = prompts.str.extract(
            r"(?s)## User prompt\n(.*)\n\n## Reference \(ground truth\) completion\n(.*)\n\n"
            r"## Model completion to score\n(.*)\n\n## Task\n", expand=True)
        lp, lr, lc = (parts[i].str.len() for i in range(3))
        return ('{"accuracy": ' + (lc % 11).astype(str) + ', "relevance": ' + (lr % 11).astype(str)
                + ', "tone": ' + (lp % 11).astype(str) + "}")
    return fn
