"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query derives its input view from the driver tables (``fixtures``), runs
the operator under test over the whole table and projects scalar, aliased
columns so that the DuckDB oracle (``oracle.py``) can be compared row for row.
Doubles are rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatscope.operators import template as T
from chatscope.plans import fixtures as FX

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


# ------------------------------------------------------------ flagship (D4-D7, K4 columns)
@register
def q_prompt_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = FX.chats(spark, sf_dir)
    r = T.with_rendered(chats, "messages")
    return r.select(
        "conv_id", "split",
        F.size("messages").alias("n_messages"), "last_role", "prefix_ok",
        "prompt", "completion",
        (F.length("prompt") + F.length("completion")).alias("n_chars"),
    )


# ------------------------------------------------------------ template programs
@register
def q_render_template_programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation through two template programs of different make."""
    from chatscope.operators.chat_template import with_template
    from chatscope.plans.templates import CHATML, INST
    chats = FX.chats(spark, sf_dir).select("conv_id", "messages")
    a = with_template(chats, CHATML).select("conv_id", "messages", F.col("full").alias("chatml"),
                                            F.col("prompt").alias("chatml_prompt"), F.col("prefix_ok").alias("chatml_ok"))
    return with_template(a, INST, bos_token="<s>", eos_token="</s>").select(
        "conv_id", "chatml", "chatml_prompt", "chatml_ok", F.col("full").alias("inst"), F.col("prompt").alias("inst_prompt"),
        F.col("completion").alias("inst_completion"))


@register
def q_render_tool_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool-calling records through the default format, written as a template program."""
    from chatscope.operators.chat_template import with_template
    from chatscope.operators.records import valid
    from chatscope.plans.templates import MARKERS
    r = with_template(valid(_parsed(spark, sf_dir)), MARKERS, "messages", "tools_json")
    return r.select("sample_id", "full", "prompt", "completion", "prefix_ok")


# ------------------------------------------------------------ records
def _scratch(spark: SparkSession, tag: str) -> str:
    import uuid

    from chatscope.session import scratch_path
    return scratch_path(spark, f"{tag}-{uuid.uuid4().hex[:12]}")


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.records import parse_records
    return parse_records(FX.tool_records(spark, sf_dir))


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.records import valid
    return T.with_rendered(valid(_parsed(spark, sf_dir)), "messages", "tools_json")


@register
def q_scan_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.sources.readers import read_text_lines
    path = _scratch(spark, "lines")
    FX.tool_records(spark, sf_dir).select("text").write.mode("overwrite").text(path)
    return read_text_lines(spark, path).select("text")


@register
def q_parse_chat_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parsed(spark, sf_dir)
    return p.select("sample_id", "reason", "decoded_from", "split", "n_messages", "tools_json")


@register
def q_cached_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.sources.readers import cached_dataset
    path = _scratch(spark, "cache")
    first = cached_dataset(spark, path, lambda: FX.tool_records(spark, sf_dir))
    # second call must hit the cache, not rebuild
    return cached_dataset(spark, path, lambda: first.limit(0)).select("sample_id", "text")


@register
def q_arrow_dataset_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1 saved as a folder of Arrow shards and read back, by byte ranges of the shards."""
    from chatscope.sources.arrow_dataset import read_arrow_dataset, write_arrow_dataset
    path = _scratch(spark, "arrow")
    write_arrow_dataset(FX.tool_records(spark, sf_dir), path, split="train")
    return read_arrow_dataset(spark, path, columns=["text", "sample_id"], partition_bytes=1 << 20)


def _valid_view(p: DataFrame) -> DataFrame:
    m = F.col("messages")
    return p.select(
        "sample_id", "split", F.size(m).alias("n_messages"),
        F.try_element_at(m, F.lit(2))["content"].alias("user_content"),
        F.try_element_at(F.try_element_at(m, F.lit(3))["tool_calls"], F.lit(1))["name"].alias("call_name"),
        F.try_element_at(F.try_element_at(m, F.lit(3))["tool_calls"], F.lit(1))["arguments_json"].alias("args_json"),
    )


@register
def q_valid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.records import valid
    return _valid_view(valid(_parsed(spark, sf_dir)))


@register
def q_quarantine_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.records import quarantine
    return quarantine(_parsed(spark, sf_dir)).select("sample_id", "reason")


@register
def q_quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.records import quarantine_counts
    return quarantine_counts(_parsed(spark, sf_dir))


@register
def q_decode_nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parsed(spark, sf_dir).where(F.col("decoded_from").isin("string", "repaired"))
    return p.select("sample_id", "decoded_from", F.size("messages").alias("n_messages"),
                    F.array_join(F.transform("messages", lambda x: x["role"]), ",").alias("roles"))


def _broken_msgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1 message lists in four spellings: single quotes, trailing comma, unquoted keys, clean."""
    p = FX._event_parts(FX.events(spark, sf_dir).select("event_id", "user_id", "event_type", "props"))
    v = F.col("sample_id") % 4
    s = (F.when(v == 0, F.replace(F.col("msgs"), F.lit('"'), F.lit("'")))
         .when(v == 1, F.concat(F.expr("substring(msgs, 1, length(msgs) - 1)"), F.lit(", ]")))
         .when(v == 2, F.replace(F.col("msgs"), F.lit('"role"'), F.lit("role")))
         .otherwise(F.col("msgs")))
    return p.select("sample_id", s.alias("raw"))


@register
def q_repair_json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.records import repair_json
    b = _broken_msgs(spark, sf_dir)
    return b.select("sample_id", F.to_json(repair_json("raw")).alias("repaired"))


def _unfinished_msgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1 message lists whose structure is broken, by ``sample_id % 8``: cut in a string, without the closing marks, without
    commas between messages, a list left open inside, cut behind a name, cut in a name, without commas between members, clean.
    """
    p = FX._event_parts(FX.events(spark, sf_dir).select("event_id", "user_id", "event_type", "props"))
    v, m = F.col("sample_id") % 8, F.col("msgs")
    upto = lambda mark, more: F.substring(m, F.lit(1), F.instr(m, F.lit(mark)) + more)
    s = (F.when(v == 0, upto('"}, {"role": "assistant"', -5))
         .when(v == 1, F.regexp_replace(m, r"[\]}]+\z", ""))
         .when(v == 2, F.replace(m, F.lit("}, {"), F.lit("} {")))
         .when(v == 3, F.concat(F.substring(m, F.lit(1), F.length(m) - 3), F.lit("}]")))
         .when(v == 4, upto('"tool_calls":', 12))
         .when(v == 5, upto('"tool_calls":', 7))
         .when(v == 6, F.replace(m, F.lit('", "content"'), F.lit('" "content"')))
         .otherwise(m))
    return p.select("sample_id", s.alias("raw"))


@register
def q_repair_json_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.records import repair_json, repair_kind
    return _unfinished_msgs(spark, sf_dir).select(
        "sample_id", F.to_json(repair_json("raw")).alias("repaired"), repair_kind("raw").alias("kind"))


@register
def q_unwrap_singleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.records import unwrap_singleton
    p = FX._event_parts(FX.events(spark, sf_dir).select("event_id", "user_id", "event_type", "props"))
    v = F.col("sample_id") % 5
    wrapped = (F.when(v == 0, F.concat(F.lit("["), F.col("msgs"), F.lit("]")))
               .when(v == 1, F.concat(F.lit("[["), F.col("msgs"), F.lit("]]")))
               .when(v == 2, F.concat(F.lit("[" * 9), F.col("msgs"), F.lit("]" * 9)))
               .when(v == 3, F.concat(F.lit("[["), F.col("msgs"), F.lit("],[1],[2]]")))
               .otherwise(F.col("msgs")))
    u = unwrap_singleton(F.try_parse_json(wrapped))
    return p.select("sample_id", F.size(F.try_variant_get(u, "$", "array<variant>")).alias("n_items"),
                    F.regexp_extract(F.schema_of_variant(F.try_variant_get(u, "$[0]", "variant")), "^([A-Z]+)", 1)
                    .alias("first_type"))


@register
def q_split_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.records import split_filter
    return split_filter(_prepared(spark, sf_dir), "train").select("sample_id", "split", "prompt", "completion")


@register
def q_split_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.records import split_filter
    return split_filter(_prepared(spark, sf_dir), "eval").select("sample_id", "split", "prompt", "completion")


@register
def q_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.records import split_counts, valid
    return split_counts(valid(_parsed(spark, sf_dir)))


@register
def q_render_chat_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir).select("sample_id", "full")


@register
def q_render_chat_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir).select("sample_id", "prompt", "prefix_ok")


@register
def q_assemble_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.records import assemble_messages
    a = assemble_messages(FX.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return a.select("conv_id", F.size("messages").alias("n_messages"),
                    F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
                    F.md5(F.array_join(F.transform("messages", lambda m: m["content"]), "\u0001")).alias("content_md5"))


@register
def q_explode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.records import assemble_messages, explode_messages
    a = assemble_messages(FX.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return explode_messages(a)


# ------------------------------------------------------------ extraction & exact-match scoring
MODELS = ["fine_tuned", "baseline"]


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators import scoring as S
    from chatscope.operators.records import split_filter, valid
    targets = S.eval_targets(split_filter(valid(_parsed(spark, sf_dir)), "eval"))
    return S.score_generations(targets, FX.generations(spark, sf_dir), MODELS)


def _json_list(c):
    return F.concat(F.lit("["), F.array_join(c, ","), F.lit("]"))


@register
def q_extract_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.functions import toolcalls as TC
    g = FX.generations(spark, sf_dir)
    x = g.select("model", "sample_id", F.posexplode(TC.extract_calls("output")).alias("call_no", "c"))
    return x.select("model", "sample_id", "call_no", F.col("c.name").alias("name"),
                    F.element_at(TC.canonical_args(F.array("c")), 1).alias("args_json"))


@register
def q_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.functions import toolcalls as TC
    g = FX.generations(spark, sf_dir)
    return g.select("model", "sample_id", TC.extract_text("output").alias("output_text"))


@register
def q_strip_prompt_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _prepared(spark, sf_dir).select("sample_id", "prompt")
    g = FX.generations(spark, sf_dir)
    # a parsed record's size is underestimated many times, so the prompts would go to the driver for a broadcast
    j = g.join(p.hint("merge"), "sample_id")
    generated = F.concat(F.col("prompt"), F.lit("\n "), F.col("output"), F.lit(" \n"))
    return j.select("model", "sample_id", T.strip_prompt_prefix(generated, F.col("prompt")).alias("model_output"))


@register
def q_eval_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.functions import toolcalls as TC
    from chatscope.operators import scoring as S
    from chatscope.operators.records import split_filter, valid
    t = S.eval_targets(split_filter(valid(_parsed(spark, sf_dir)), "eval"))
    return t.select("sample_id", "user", F.to_json(TC.call_names(F.col("target_fc"))).alias("target_names"),
                    _json_list(TC.canonical_target_args(F.col("target_fc"))).alias("target_arguments"),
                    "target_text")


@register
def q_score_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("model", "sample_id", "correct_names", "correct_arguments", "correct")


@register
def q_scored_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scored(spark, sf_dir)
    return s.select("model", "sample_id", "user",
                    F.to_json("target_names").alias("target_names"), F.to_json("output_names").alias("output_names"),
                    _json_list(F.col("target_arguments")).alias("target_arguments"),
                    _json_list(F.col("output_arguments")).alias("output_arguments"),
                    "target_text", "output_text", "correct_names", "correct_arguments", "correct")


@register
def q_review_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.scoring import review_errors
    r = review_errors(_scored(spark, sf_dir))
    return r.select("model", "sample_id", "prompt",
                    F.to_json("expected_names").alias("expected_names"),
                    _json_list(F.col("expected_arguments")).alias("expected_arguments"),
                    F.to_json("actual_names").alias("actual_names"),
                    _json_list(F.col("actual_arguments")).alias("actual_arguments"))


@register
def q_accuracy_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.scoring import accuracy_by_model
    a = accuracy_by_model(_scored(spark, sf_dir))
    return a.select("model", F.round("accuracy", 6).alias("accuracy"), "n")


@register
def q_align_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators import scoring as S
    from chatscope.operators.records import split_filter, valid
    t = S.eval_targets(split_filter(valid(_parsed(spark, sf_dir)), "eval"))
    a = S.align_generations(t, FX.generations(spark, sf_dir), MODELS)
    return a.select("model", "sample_id", F.col("output").isNotNull().alias("has_output"),
                    F.length("output").alias("output_chars"))


@register
def q_compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.scoring import compare_models
    return compare_models(_scored(spark, sf_dir), "fine_tuned", "baseline")


@register
def q_pair_ref_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.scoring import pair_ref_pred
    p = FX.pairs(spark, sf_dir)
    refs = p.where(F.col("model") == "fine_tuned").select("sample_id", "reference")
    preds = p.select("model", "sample_id", "prediction")
    j = pair_ref_pred(refs, preds)
    return j.select("model", "sample_id", F.length("reference").alias("ref_chars"),
                    F.length("prediction").alias("pred_chars"))


# ------------------------------------------------------------ text metrics
def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if c in cols else c for c in df.columns])


@register
def q_rouge_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.metrics import rouge_n
    return _r6(rouge_n(FX.metric_pairs(spark, sf_dir)), "value")


@register
def q_rouge_n_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.metrics import rouge_n
    return _r6(rouge_n(FX.metric_pairs(spark, sf_dir), stem=True), "value")


@register
def q_rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.metrics import rouge_l
    return _r6(rouge_l(FX.metric_pairs(spark, sf_dir)), "value")


@register
def q_rouge_lsum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary-level ROUGE-L through the metric selection, plain and per model."""
    from chatscope.operators.metrics import metrics_long
    return _r6(metrics_long(FX.metric_pairs(spark, sf_dir), bleu_=False, chrf_=False, rouge_keys=("rougeLsum",), stem=False), "value")


@register
def q_rouge_l_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2L: ROUGE-L over whole documents."""
    from chatscope.operators.metrics import rouge_l_per_sample
    s = rouge_l_per_sample(FX.long_pairs(spark, sf_dir))
    return _r6(s.select("model", "sample_id", "lcs", "f1"), "f1")


@register
def q_stem_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.functions.ngrams import rouge_tokens
    from chatscope.functions.porter import stem_udf
    p = FX.pairs(spark, sf_dir)
    words = p.select(F.explode(F.concat(rouge_tokens("prediction"), rouge_tokens("reference"))).alias("token")).distinct()
    return words.select("token", stem_udf("token").alias("stem"))


@register
def q_bleu_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.metrics import bleu
    return _r6(bleu(FX.metric_pairs(spark, sf_dir)), "value")


@register
def q_chrf_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.metrics import chrf
    return _r6(chrf(FX.metric_pairs(spark, sf_dir)), "value")


@register
def q_embedding_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.metrics import embedding_match
    return _r6(embedding_match(FX.token_vectors(spark, sf_dir)), "precision", "recall", "f1")


@register
def q_bertscore_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts to token vectors in overlapping windows, then the embedding match, per sample."""
    from chatscope.operators.encoding import encode_tokens, make_hash_encoder
    from chatscope.operators.metrics import embedding_match
    vectors = encode_tokens(FX.pairs(spark, sf_dir), make_hash_encoder, window=24, overlap=8)
    return _r6(embedding_match(vectors, keys=("model", "sample_id")), "precision", "recall", "f1")


@register
def q_metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.metrics import metrics_long
    return _r6(metrics_long(FX.metric_pairs(spark, sf_dir), vectors=FX.model_vectors(spark, sf_dir)), "value")


# ------------------------------------------------------------ config registry
EXCEPT_1 = ("NumEpochs",)
EXCEPT_2 = ("NumEpochs", "Model/opt/k")


def _with_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.registry import with_nodes
    return with_nodes(FX.configs(spark, sf_dir))


@register
def q_json_key_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.registry import key_paths
    return key_paths(FX.configs(spark, sf_dir))


@register
def q_json_delete_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.registry import delete_path, explode_nodes
    return explode_nodes(delete_path(_with_nodes(spark, sf_dir), "Model/opt/k")).select("config_id", "path", "value_json")


@register
def q_json_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.registry import explode_nodes, paths_of, prune
    n = _with_nodes(spark, sf_dir)
    return explode_nodes(prune(n, paths_of(n, 0), EXCEPT_1)).select("config_id", "path", "value_json")


@register
def q_config_identical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.registry import config_identical
    return config_identical(_with_nodes(spark, sf_dir), 0, EXCEPT_2)


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = FX.events(spark, sf_dir).select("event_id", "event_type")
    cfg = FX.configs(spark, sf_dir)
    return cfg.join(ev.where(F.col("event_type") == "view"), F.col("config_id") == F.col("event_id"), "left_semi") \
        .select(F.col("config_id").alias("run_id"), "config")


@register
def q_assign_run_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.registry import assign_run_slot
    return assign_run_slot(FX.configs(spark, sf_dir), _registry(spark, sf_dir), EXCEPT_2)


@register
def q_register_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A durable registry: half of the configurations registered, then all, then all again, which finds every slot."""
    from chatscope.operators.run_store import RunStore
    store, configs = RunStore(spark, _scratch(spark, "runs")), FX.configs(spark, sf_dir)
    store.register(configs.where("config_id % 2 = 0"), EXCEPT_2)
    store.register(configs, EXCEPT_2)
    return store.register(configs, EXCEPT_2)


@register
def q_registry_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.registry import match_registry
    m = match_registry(FX.configs(spark, sf_dir), _registry(spark, sf_dir), EXCEPT_2)
    return m.select("config_id", "status", "matched_run", "n_matches")


@register
def q_config_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.registry import overlay
    ev = FX.events(spark, sf_dir).select("event_id", "event_type")
    docs = FX.configs(spark, sf_dir).join(ev, F.col("config_id") == F.col("event_id"))
    return overlay(docs, "event_type", "event_id")


# ------------------------------------------------------------ sampling (K1-K5)
@register
def q_shuffle_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.sampling import shuffle_seeded
    return shuffle_seeded(FX.tool_records(spark, sf_dir), "sample_id", 42).select("sample_id", "rank")


@register
def q_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.sampling import sample_rows
    return sample_rows(FX.tool_records(spark, sf_dir), "sample_id", 5, 42).select("sample_id", "text")


@register
def q_sample_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.sampling import sample_fraction
    return sample_fraction(FX.tool_records(spark, sf_dir), "sample_id", 0.05, 42).select("sample_id", "text")


@register
def q_longest_example(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.sampling import longest_example
    p = _prepared(spark, sf_dir).select("sample_id", "prompt", "completion")
    return longest_example(p, "sample_id", ["prompt", "completion"]).select("sample_id", "n_chars")


@register
def q_max_sequence_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.sampling import max_sequence_length
    p = _prepared(spark, sf_dir).select("sample_id", "prompt", "completion")
    return max_sequence_length(p, "sample_id", ["prompt", "completion"])


@register
def q_cap_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.records import split_filter
    from chatscope.operators.sampling import cap_eval
    ev = split_filter(_prepared(spark, sf_dir), "eval").select("sample_id", "prompt")
    return cap_eval(ev, "sample_id", 100)


# ------------------------------------------------------------ prompt lines, tools, clock
@register
def q_prompt_lines_escaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.sources.readers import prompt_lines
    return prompt_lines(FX.prompt_lines(spark, sf_dir)).select("item_id", "line_no", "user_prompt", "rejected")


def _adhoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D14 + K6: every prompt line with the tools of the first valid record."""
    from chatscope.operators.records import first_tools
    from chatscope.sources.readers import prompt_lines
    lines = prompt_lines(FX.prompt_lines(spark, sf_dir)).where(~F.col("rejected"))
    tools = first_tools(FX.tool_records(spark, sf_dir), "sample_id")
    return lines.select("item_id", "line_no", "user_prompt", F.lit(tools).alias("tools_json"))


@register
def q_prompt_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 from a text file: the prompt lines written as one line each and read back (without their places)."""
    from chatscope.sources.readers import read_prompt_file
    path = _scratch(spark, "prompts")
    FX.prompt_lines(spark, sf_dir).select("line").write.text(path)
    return read_prompt_file(spark, path).select("user_prompt", "rejected")


@register
def q_attach_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _adhoc(spark, sf_dir).select("item_id", "line_no", "tools_json")


@register
def q_render_adhoc_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _adhoc(spark, sf_dir).withColumn(
        "messages", T.adhoc_messages(F.lit(T.DEVELOPER_FIXED), F.col("user_prompt")))
    return T.with_rendered(a, "messages", "tools_json").select(
        "item_id", "line_no", F.concat("full", F.lit(T.DEFAULT_TEMPLATE.generation_header)).alias("prompt"))


@register
def q_render_time_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = FX.events(spark, sf_dir).select("event_id", "ts")
    return ev.select("event_id", T.time_context("ts").alias("developer_content"))


# ------------------------------------------------------------ sinks
@register
def q_export_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.sources.sinks import export_csv, read_csv_export
    path = _scratch(spark, "csv")
    p = _prepared(spark, sf_dir).select(F.col("sample_id").alias("row_id"), "split", "prompt", "completion")
    export_csv(p, path)
    return read_csv_export(spark, path, "row_id long, split string, prompt string, completion string")


@register
def q_scored_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.sources.sinks import write_json
    path = _scratch(spark, "json")
    write_json(_scored(spark, sf_dir), path)
    back = spark.read.schema(
        "model string, sample_id long, user string, target_names array<string>, output_names array<string>, "
        "target_arguments array<string>, output_arguments array<string>, target_text string, output_text string, "
        "correct_names boolean, correct_arguments boolean, correct boolean").json(path)
    return back.withColumns({
        **{c: F.to_json(c) for c in ("target_names", "output_names")},
        **{c: _json_list(F.col(c)) for c in ("target_arguments", "output_arguments")}})


@register
def q_eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.inference import make_length_judge
    from chatscope.operators.judge import judge_aggregate, judge_batch
    from chatscope.operators.metrics import metrics_long
    from chatscope.sources.sinks import report_document, write_report
    pairs = FX.pairs(spark, sf_dir)
    judged = judge_aggregate(judge_batch(pairs, make_length_judge)).drop("n_failed")
    m = metrics_long(FX.metric_pairs(spark, sf_dir), vectors=FX.model_vectors(spark, sf_dir)).unionByName(judged)
    n = pairs.select(F.count_distinct("sample_id")).scalar()
    doc = report_document(m, {"use_fine_tuned": True, "use_baseline": True, "num_eval_samples": n})
    path = _scratch(spark, "report")
    write_report(doc, path)
    back = spark.read.schema(
        "config struct<use_fine_tuned:boolean,use_baseline:boolean,num_eval_samples:long>, "
        "models map<string,map<string,double>>, timestamp string").json(path)
    rows = back.select("config", F.explode("models").alias("model", "metrics")).select(
        "config.*", "model", F.explode("metrics").alias("metric", "value"))
    return _r6(rows, "value")


# ------------------------------------------------------------ generation & judge
@register
def q_batch_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.inference import batch_generate, make_echo_tool_model
    from chatscope.operators.records import split_filter
    ev = split_filter(_prepared(spark, sf_dir), "eval").select("sample_id", "prompt")
    return batch_generate(ev, make_echo_tool_model, "prompt", "output", ["sample_id"])


@register
def q_judge_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.judge import judge_prompt
    p = FX.pairs(spark, sf_dir)
    return p.select("model", "sample_id", judge_prompt("prompt", "reference", "prediction").alias("judge_prompt"))


@register
def q_judge_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.inference import make_length_judge
    from chatscope.operators.judge import judge_batch
    j = judge_batch(FX.pairs(spark, sf_dir), make_length_judge)
    return j.select("model", "sample_id", "accuracy", "relevance", "tone", "failed")


def make_failing_judge():
    """The length judge, but a task whose prompts hold a marked one dies (not an error of a call: the whole task)."""
    from chatscope.operators.inference import make_length_judge
    judge = make_length_judge()

    def fn(prompts):
        if prompts.str.len().mod(97).eq(0).any():
            raise SystemExit("worker lost")
        return judge(prompts)
    return fn


@register
def q_judge_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judging that dies half-way, then goes on from its journal; ``times_sent`` counts the replies on record."""
    from chatscope.operators.inference import make_length_judge
    from chatscope.operators.judge import SYSTEM_PROMPT, judge_prompt
    from chatscope.operators.judge_journal import JudgeJournal, prompt_key, resume
    journal, pairs = JudgeJournal(spark, _scratch(spark, "journal")), FX.pairs(spark, sf_dir)
    try:
        resume(journal, pairs, make_failing_judge, task_rows=20)
    except Exception as e:  # the lost worker
        if "worker lost" not in str(e):
            raise
    done = resume(journal, pairs, make_length_judge, task_rows=20)
    sent = journal.read().where("valid").groupBy("key").agg(F.count(F.lit(1)).alias("times_sent"))
    key = prompt_key(judge_prompt("prompt", "reference", "prediction"), SYSTEM_PROMPT)
    keys = pairs.select("model", "sample_id", key.alias("key")).join(sent, "key").drop("key")
    return done.join(keys, ["model", "sample_id"]).select("model", "sample_id", "accuracy", "relevance", "tone", "failed", "times_sent")


@register
def q_judge_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.judge import parse_judge_reply
    j = parse_judge_reply(FX.judge_replies(spark, sf_dir))
    return j.select("model", "sample_id", "accuracy", "relevance", "tone", "failed")


@register
def q_judge_parse_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge replies with text around the object, two objects, repeated keys and repeated nulls."""
    from chatscope.operators.judge import parse_judge_reply
    e = FX.events(spark, sf_dir).select("event_id", "props")
    k = FX._k(F.col("props")) % 11
    obj = lambda a: F.concat(F.lit('{"accuracy": '), a.cast("string"), F.lit(', "relevance": 4, "tone": 2'))
    v = F.col("event_id") % 7
    reply = (F.when(v == 0, F.concat(obj(k), F.lit("} hope this helps")))
             .when(v == 1, F.concat(obj(k), F.lit("}\n\t ")))
             .when(v == 2, F.concat(obj(k), F.lit(', "accuracy": 3}')))
             .when(v == 3, F.concat(obj(k), F.lit("} "), obj(k), F.lit("}")))
             .when(v == 4, F.concat(obj(k), F.lit(', "accuracy": null}')))
             .when(v == 5, F.concat(obj(k), F.lit('}, {"accuracy": 1}')))
             .otherwise(F.concat(F.lit(" "), obj(k), F.lit(', "extra": {"a": 1, "a": 2}}'))))
    j = parse_judge_reply(e.select(F.col("event_id").alias("sample_id"), reply.alias("reply")))
    return j.select("sample_id", "accuracy", "relevance", "tone", "failed")


@register
def q_record_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean records with something behind them, by ``sample_id % 6``."""
    from chatscope.operators.records import parse_records
    p = FX._event_parts(FX.events(spark, sf_dir).select("event_id", "user_id", "event_type", "props"))
    line = F.concat(F.lit('{"messages": '), F.col("msgs"), F.lit(', "tools": '), F.col("tools"), F.lit(', "metadata": "train"'))
    v = F.col("sample_id") % 6
    text = (F.when(v == 0, F.concat(line, F.lit("}"))).when(v == 1, F.concat(F.lit(" "), line, F.lit("} \t")))
            .when(v == 2, F.concat(line, F.lit("} and more"))).when(v == 3, F.concat(line, F.lit("}{}")))
            .when(v == 4, F.concat(line, F.lit(', "metadata": "eval"} x'))).otherwise(F.concat(line, F.lit(', "metadata": "eval"}'))))
    return parse_records(p.select("sample_id", text.alias("text"))).select("sample_id", "reason", "split")


@register
def q_judge_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatscope.operators.judge import judge_aggregate, parse_judge_reply
    return _r6(judge_aggregate(parse_judge_reply(FX.judge_replies(spark, sf_dir))), "value")
