"""Run-configuration registry as JSON-table jobs (M1–M6).

A configuration is a nested JSON object. ``with_nodes`` turns each document,
row by row and to its full depth, into an array of nodes ``(path, depth, kind,
value_json)`` with paths ``a``, ``a/b``, ... (inner nodes included; arrays are
values). Deleting, pruning and fingerprinting are expressions over that array, so
no document is exploded and collected again and none is lost: ``{}``, null and
unparseable documents keep their row and carry a ``status``.

Pruning keeps a node when its path is one of the base keys and neither it nor
any ancestor is an exception. Two pruned trees are equal when their entries
(path, kind and, but for objects, value) are equal. Numbers compare by value: ``1`` and ``1.0`` are the
same entry.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatscope.operators.sampling import consecutive_index
from chatscope.session import materialize

NODE = "struct<path:string,depth:int,kind:string,value_json:string,entry:string>"
STATUSES = ("ok", "null", "invalid_json", "not_object", "too_deep")
_KINDS = {dict: "OBJECT", list: "ARRAY", str: "STRING", bool: "BOOLEAN", int: "BIGINT", float: "DOUBLE", type(None): "VOID"}
_SEP = "\u0001"


def _dump(value: object) -> str:
    """Compact JSON with sorted keys, for a value of any depth."""
    try:
        return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    except RecursionError:
        pass
    out, todo = [], [(False, value)]  # (is text, text or value)
    while todo:
        is_text, v = todo.pop()
        if is_text:
            out.append(v)
        elif isinstance(v, (dict, list)) and v:
            parts = [(True, "{" if isinstance(v, dict) else "[")]
            for n, x in enumerate(sorted(v) if isinstance(v, dict) else v):
                parts.append((True, ("," if n else "") + (f"{_dump(x)}:" if isinstance(v, dict) else "")))
                parts.append((False, v[x] if isinstance(v, dict) else x))
            todo += reversed([*parts, (True, "}" if isinstance(v, dict) else "]")])
        else:
            out.append(_dump(v))
    return "".join(out)


def _plain_numbers(value: object) -> object:
    """Whole floats as integers, all the way down."""
    whole = lambda v: int(v) if isinstance(v, float) and v.is_integer() else v
    top = [value]
    todo: list = [top]
    while todo:
        at = todo.pop()
        for k, v in (at.items() if isinstance(at, dict) else enumerate(at)):
            if isinstance(v, (dict, list)):
                v = v.copy()
                todo.append(v)
            at[k] = whole(v)
    return top[0]


def _entry(path: str, value: object, dumped: str | None) -> str:
    if isinstance(value, dict):
        return f"{path}{_SEP}OBJECT{_SEP}"
    text = dumped if dumped is not None else _dump(value)
    if not isinstance(value, (str, int)) and ("." in text or "e" in text):  # a float may be in it
        text = _dump(_plain_numbers(value))
    kind = "NUMBER" if type(value) in (int, float) else _KINDS[type(value)]
    return f"{path}{_SEP}{kind}{_SEP}{text}"


def flatten_document(text: str | None, values: bool = True) -> tuple[str, list[tuple[str, int, str, str | None, str]]]:
    """Status and nodes of one document (of a repeated key the last value counts).

    Documents nested beyond what Python's parser takes (some thousand levels) are ``too_deep``.
    """
    if text is None:
        return "null", []
    try:
        doc = json.loads(text)
    except RecursionError:
        return "too_deep", []
    except ValueError:
        return "invalid_json", []
    if not isinstance(doc, dict):
        return "not_object", []
    out, todo = [], [(k, 1, v) for k, v in reversed(doc.items())]
    while todo:
        path, depth, value = todo.pop()
        dumped = _dump(value) if values else None
        out.append((path, depth, _KINDS[type(value)], dumped, _entry(path, value, dumped)))
        if isinstance(value, dict):
            todo += [(f"{path}/{k}", depth + 1, v) for k, v in reversed(value.items())]
    return "ok", out


_NODE_ARROW = (("path", pa.string()), ("depth", pa.int32()), ("kind", pa.string()), ("value_json", pa.string()), ("entry", pa.string()))


def with_nodes(docs: DataFrame, doc_col: str = "config", values: bool = True) -> DataFrame:
    """Adds ``status`` and ``nodes`` to every row of ``docs`` (an Arrow UDF; a row's work is its own document).

    Without ``values`` the nodes' ``value_json`` stays null, which spares writing every subtree.
    """
    @F.arrow_udf(f"status string, nodes array<{NODE}>")
    def json_nodes(texts: pa.Array) -> pa.Array:
        found = [flatten_document(t, values) for t in texts.to_pylist()]
        flat = list(zip(*[n for _, nodes in found for n in nodes], strict=True)) or [()] * len(_NODE_ARROW)
        rows = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(flat, _NODE_ARROW, strict=True)],
                                          names=[n for n, _ in _NODE_ARROW])
        ends = list(accumulate((len(nodes) for _, nodes in found), initial=0))
        return pa.StructArray.from_arrays([pa.array([s for s, _ in found], pa.string()),
                                           pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)], names=["status", "nodes"])

    # declared nondeterministic so that a later filter on the status is not pushed below it with a second run of it
    once = json_nodes.asNondeterministic()
    return docs.withColumn("_n", once(F.col(doc_col))).withColumns(
        {"status": F.col("_n.status"), "nodes": F.col("_n.nodes")}).drop("_n")


def key_paths(docs: DataFrame, doc_col: str = "config", key: str = "config_id") -> DataFrame:
    """M1: one row per node, ``(key, status, path, depth, kind, value_json)``.

    A document without nodes has one row whose ``path`` is null.
    """
    return explode_nodes(with_nodes(docs.select(key, doc_col), doc_col), key)


def explode_nodes(df: DataFrame, key: str = "config_id") -> DataFrame:
    return df.select(key, "status", F.explode_outer("nodes").alias("n")).select(
        key, "status", "n.path", "n.depth", "n.kind", "n.value_json")


def _ancestors_or_self(path: Column) -> Column:
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def drop_exceptions(nodes: Column, except_keys: Sequence[str]) -> Column:
    """Without the nodes whose path or any ancestor path is in ``except_keys`` (a small literal list)."""
    if not except_keys:
        return nodes
    gone = F.lit(False)
    return F.filter(nodes, lambda n: ~_any_of(n["path"], except_keys, gone))


def _any_of(path: Column, keys: Sequence[str], start: Column) -> Column:
    out = start
    for k in keys:
        out = out | (path == k) | F.startswith(path, F.lit(k + "/"))
    return out


def delete_path(df: DataFrame, path: str, keep_falsy: bool = True) -> DataFrame:
    """M2: delete one path and its subtree in every document; a missing path is a no-op.

    ``keep_falsy=True`` reproduces the reference: a falsy value (``0``, ``""``,
    ``false``, ``null``, ``{}``, ``[]``) is not deleted.
    """
    falsy = ("0", "0.0", "-0.0", "-0", '""', "false", "null", "{}", "[]")

    def hit(n: Column) -> Column:
        own = n["path"] == path
        return own & ~n["value_json"].isin(*falsy) if keep_falsy else own

    gone = F.filter("nodes", lambda n: ~((n["path"] == path) | F.startswith(n["path"], F.lit(path + "/"))))
    return df.withColumn("nodes", F.when(F.exists("nodes", hit), gone).otherwise(F.col("nodes")))


def paths_of(df: DataFrame, base_id, key: str = "config_id") -> Column:
    """All paths of one document, as a scalar subquery bounded by that document (empty if there is none)."""
    one = df.where(F.col(key) == F.lit(base_id)).select(F.transform("nodes", lambda n: n["path"]).alias("p"))
    return F.coalesce(one.agg(F.flatten(F.collect_list("p"))).scalar(), F.array().cast("array<string>"))


def prune(df: DataFrame, base_paths: Column, except_keys: Sequence[str] = ()) -> DataFrame:
    """M3: in every document keep the nodes whose path is a base key and that are not excepted.

    The base keys of one document contain the ancestors of each, so what is kept is a tree.
    """
    kept = df.withColumn("_base", base_paths)  # a subquery may not sit under a lambda
    return kept.withColumn("nodes", drop_exceptions(
        F.filter("nodes", lambda n: F.array_contains(F.col("_base"), n["path"])), except_keys)).drop("_base")


def entries(nodes: Column) -> Column:
    """Sorted entries of a tree: equal arrays are equal trees."""
    return F.array_sort(F.transform(nodes, lambda n: n["entry"]))


def fingerprint(nodes: Column) -> Column:
    return F.md5(F.array_join(entries(nodes), "\u0002"))


def config_identical(df: DataFrame, base_id, except_keys: Sequence[str] = (), key: str = "config_id") -> DataFrame:
    """M4: for every document, is its pruned tree equal to the base document's pruned tree?

    Row-local: the base's paths and fingerprint are scalar subqueries over one
    document. A document that is no object is identical to none.
    """
    base = paths_of(df, base_id, key)
    fps = prune(df, base, except_keys).select(key, "status", fingerprint(F.col("nodes")).alias("fp"))
    base_fp = fps.where((F.col(key) == F.lit(base_id)) & (F.col("status") == "ok")).agg(F.min("fp")).scalar()
    return fps.select(key, "status", F.coalesce((F.col("fp") == base_fp) & (F.col("status") == "ok"), F.lit(False)).alias(
        "identical"))


def _trees(df: DataFrame, except_keys: Sequence[str]) -> DataFrame:
    out = df.withColumn("entries", entries(drop_exceptions(F.col("nodes"), except_keys)))
    return out.withColumn("fp", F.md5(F.array_join("entries", "\u0002"))).drop("nodes")


def match_registry(requests: DataFrame, registry: DataFrame, except_keys: Sequence[str] = (),
                   key: str = "config_id") -> DataFrame:
    """``(key, status, fp, matched_run, n_matches)`` for every request.

    A stored config matches when, pruned to the request's keys, it equals the pruned
    request; that is, when it holds all of the request's entries. Both sides are reduced to
    their distinct trees. Each request tree is joined on its entry that the fewest
    stored trees hold, and the few candidates are compared in full.
    A request without entries matches every stored config that is an object.
    """
    req = materialize(_trees(with_nodes(requests.select(key, "config"), values=False), except_keys).drop("config"))
    want = materialize(req.where("status = 'ok'").groupBy("fp").agg(F.first("entries").alias("entries")))
    have = materialize(_trees(with_nodes(registry.select("run_id", "config"), values=False), except_keys).where("status = 'ok'").groupBy(
        "fp").agg(F.first("entries").alias("entries"), F.min("run_id").alias("run_id"), F.count(F.lit(1)).alias("n")))
    held = have.select(F.col("fp").alias("stored"), F.explode("entries").alias("entry"))
    counts = held.groupBy("entry").agg(F.count(F.lit(1)).alias("held_by"))
    asked = want.select("fp", F.explode("entries").alias("entry")).join(counts, "entry", "left")
    rarest = asked.groupBy("fp").agg(F.min_by("entry", F.struct(F.coalesce("held_by", F.lit(0)), F.col("entry"))).alias("entry"))
    pairs = rarest.join(held, "entry").select("fp", "stored")
    full = pairs.join(want, "fp").join(have.select(F.col("fp").alias("stored"), F.col("entries").alias("all"), "run_id", "n"),
                                       "stored")
    best = full.where(F.size(F.array_except("entries", "all")) == 0).groupBy("fp").agg(
        F.min("run_id").alias("matched_run"), F.sum("n").alias("n_matches"))
    every = have.agg(F.min("run_id").alias("matched_run"), F.sum("n").alias("n_matches"))
    none = F.size("entries") == 0
    out = req.join(best, "fp", "left").where("TRUE")
    any_run, any_n = every.select("matched_run").scalar(), every.select("n_matches").scalar()
    ok = F.col("status") == "ok"
    return out.select(
        key, "status", F.when(ok, F.col("fp")).alias("fp"),
        F.when(ok, F.when(none, any_run).otherwise(F.col("matched_run"))).alias("matched_run"),
        F.when(ok, F.coalesce(F.when(none, any_n).otherwise(F.col("n_matches")), F.lit(0))).otherwise(0).cast("bigint").alias(
            "n_matches"))


def assign_run_slot(requests: DataFrame, registry: DataFrame, except_keys: Sequence[str] = (),
                    key: str = "config_id") -> DataFrame:
    """M5: find-or-assign a run slot: ``(key, status, run_id, reused)``, one row per request.

    ``requests``: ``(config_id, config)``; ``registry``: ``(run_id, config)``.
    A request reuses the lowest matching ``run_id`` (``match_registry``). Unmatched
    requests get new slots ``max(run_id) + 1, + 2, ...`` in order of their first config
    id; identical unmatched requests share one. A request that is no object gets none.
    """
    matched = materialize(match_registry(requests, registry, except_keys, key))
    max_run = registry.select(F.coalesce(F.max("run_id"), F.lit(0))).scalar()
    new = matched.where("status = 'ok' AND matched_run IS NULL").groupBy("fp").agg(F.min(key).alias("first_id"))
    slots = consecutive_index(new, "first_id").select("fp", (max_run + F.col("idx") + 1).alias("new_run"))
    return matched.join(slots, "fp", "left").select(
        key, "status", F.coalesce("matched_run", "new_run").alias("run_id"), F.col("matched_run").isNotNull().alias("reused"))


def overlay(docs: DataFrame, group: str, priority: str, doc_col: str = "config") -> DataFrame:
    """M6: top-level overlay (``dict.update``) of the documents of each group in priority order."""
    top = with_nodes(docs.select(group, priority, doc_col), doc_col).select(
        group, priority, F.explode(F.filter("nodes", lambda n: n["depth"] == 1)).alias("n"))
    return top.groupBy(group, F.col("n.path").alias("key")).agg(
        F.max_by(F.col("n.value_json"), F.col(priority)).alias("value_json"))
