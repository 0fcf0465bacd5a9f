"""DuckDB oracle SQL for every registered query (tables pre-registered as views).

Written independently of the Spark code: fixtures are rebuilt with plain SQL,
rendering and scoring are done at row level with ``string_agg`` / list lambdas.
"""

from __future__ import annotations

from chatscope.operators.template import CLOCK_DAY, CLOCK_FORMAT_INTRO, DEVELOPER_CLOCK_INTRO, DEVELOPER_FIXED
from chatscope.plans.fixtures import DEVELOPER_TEXT


def h(x: str) -> str:
    """First 8 hex digits of md5(x as text) as an integer."""
    return f"('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 8))::BIGINT"


NL = "chr(10)"

# FX0 chats rendered at turn level: segment per turn, then ordered string_agg.
CHAT_TURNS = f"""
turns AS (
  SELECT conv_id, turn, role, text,
         '<start_of_turn>' || CASE WHEN role = 'assistant' THEN 'model' ELSE role END || {NL}
           || coalesce(text, '') || '<end_of_turn>' || {NL} AS seg,
         max(turn) OVER (PARTITION BY conv_id) AS last_turn
  FROM conversations
),
chat AS (
  SELECT conv_id,
         CASE WHEN {h('conv_id')} % 10 = 0 THEN 'eval' ELSE 'train' END AS split,
         count(*) AS n_messages,
         max(CASE WHEN turn = last_turn THEN role END) AS last_role,
         coalesce(string_agg(seg, '' ORDER BY turn) FILTER (WHERE turn < last_turn), '') AS head,
         max(CASE WHEN turn = last_turn THEN seg END) AS last_seg
  FROM turns GROUP BY conv_id
),
rendered AS (
  SELECT conv_id, split, n_messages, last_role,
         head || last_seg AS "full",
         head || '<start_of_turn>model' || {NL} AS prompt
  FROM chat
)"""

SQL: dict[str, str] = {}

SQL["prompt_completion"] = f"""
WITH {CHAT_TURNS}
SELECT conv_id, split, n_messages, last_role,
       starts_with("full", prompt) AS prefix_ok,
       prompt,
       substring("full", length(prompt) + 1) AS completion,
       length(prompt) + length(substring("full", length(prompt) + 1)) AS n_chars
FROM rendered
"""


# FX1 tool_records built by plain string concatenation, plus the expected parse outcome.
FX1 = """
ev AS (
  SELECT event_id AS sample_id, event_type AS et, CAST(user_id AS VARCHAR) AS uid,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
asks AS (
  SELECT *, et || ' for user ' || uid || CASE WHEN sample_id % 16 IN (1, 5)
    THEN ' (True, or None of these? pick [a, ] or {b , } False)' ELSE '' END AS ask FROM ev
),
parts AS (
  SELECT sample_id, et, uid, k, ask,
    '[{"role": "developer", "content": "@DEV@"}, {"role": "user", "content": "' || ask
      || '"}, {"role": "assistant", "tool_calls": [{"function": {"name": "' || et || '", "arguments": '
      || CASE WHEN sample_id % 3 = 0 THEN '{"k": ' || CAST(k AS VARCHAR) || '}'
              ELSE '{"k": "' || CAST(k AS VARCHAR) || '", "user": "' || uid || '"}' END
      || '}}]}]' AS msgs,
    '[{"function":{"description":"Handle a ' || et || ' event","name":"' || et
      || '","parameters":{"properties":{"k":{"type":"string"},"user":{"type":"string"}},"type":"object"}},"type":"function"}]' AS tools,
    CASE sample_id % 10 WHEN 0 THEN 'eval' WHEN 1 THEN 'holdout' ELSE 'train' END AS meta,
    CASE WHEN sample_id % 3 = 0 THEN '{"k":' || CAST(k AS VARCHAR) || '}'
         ELSE '{"k":"' || CAST(k AS VARCHAR) || '","user":"' || uid || '"}' END AS args_json,
    'k:<escape>' || CAST(k AS VARCHAR) || '<escape>'
      || CASE WHEN sample_id % 3 = 0 THEN '' ELSE ',user:<escape>' || uid || '<escape>' END AS pairs
  FROM asks
),
fx1 AS (
  SELECT *,
    CASE WHEN sample_id % 32 = 3 THEN replace(full_line, '"role": "developer", ', '')
      WHEN sample_id % 32 = 11 THEN replace(full_line, '"messages": [', '"messages": ["hello", ')
      WHEN sample_id % 32 = 19 THEN replace(full_line, '{"function": {"name": "' || et || '", ', '{"function": {')
      WHEN sample_id % 32 = 27 THEN substring(full_line, 1, length(full_line) - 1) || ', "metadata": "twice"}'
      ELSE CASE sample_id % 8
      WHEN 4 THEN '{"messages": "' || replace(msgs, '"', '\\"') || '", "tools": ' || tools || ', "metadata": "' || meta || '"}'
      WHEN 5 THEN '{"messages": "' || replace(msgs, '"', '''') || '", "tools": ' || tools || ', "metadata": "' || meta || '"}'
      WHEN 6 THEN '{"messages": ' || msgs || ', "metadata": "' || meta || '"}'
      WHEN 7 THEN substring(full_line, 1, length(full_line) // 2)
      ELSE full_line END END AS text,
    CASE WHEN sample_id % 8 = 3 THEN ['message_without_role', 'message_not_object', 'call_without_name', 'duplicate_key'][
           (sample_id % 32) // 8 + 1] WHEN sample_id % 8 = 6 THEN 'missing_tools' WHEN sample_id % 8 = 7 THEN 'invalid_json' END AS reason,
    CASE WHEN sample_id % 32 = 27 THEN NULL ELSE CASE sample_id % 8 WHEN 4 THEN 'string' WHEN 5 THEN 'repaired' WHEN 7 THEN NULL ELSE 'native' END END AS decoded_from
  FROM (SELECT *, '{"messages": ' || msgs || ', "tools": ' || tools || ', "metadata": "' || meta || '"}' AS full_line
        FROM parts) p
),
ok AS (
  SELECT *,
    '<start_of_turn>developer' || chr(10) || '<tools>' || tools || '</tools><end_of_turn>' || chr(10)
      || '<start_of_turn>developer' || chr(10) || '@DEV@<end_of_turn>' || chr(10)
      || '<start_of_turn>user' || chr(10) || ask || '<end_of_turn>' || chr(10) AS head,
    '<start_of_turn>model' || chr(10) || '<start_function_call>call:' || et || '{' || pairs
      || '}<end_function_call><end_of_turn>' || chr(10) AS last_seg
  FROM fx1 WHERE reason IS NULL
)""".replace("@DEV@", DEVELOPER_TEXT)

SQL["scan_text_lines"] = f"WITH {FX1} SELECT text FROM fx1"

SQL["parse_chat_record"] = f"""WITH {FX1}
SELECT sample_id, reason, decoded_from,
       CASE WHEN reason IS NULL THEN meta END AS split,
       CASE WHEN reason IS NULL THEN 3 END AS n_messages,
       CASE WHEN reason IS NULL THEN tools END AS tools_json
FROM fx1"""

SQL["cached_dataset"] = f"WITH {FX1} SELECT sample_id, text FROM fx1"

SQL["arrow_dataset_scan"] = SQL["cached_dataset"]

SQL["valid_records"] = f"""WITH {FX1}
SELECT sample_id, meta AS split, 3 AS n_messages, ask AS user_content,
       et AS call_name, args_json
FROM fx1 WHERE reason IS NULL"""

SQL["quarantine_records"] = f"WITH {FX1} SELECT sample_id, reason FROM fx1 WHERE reason IS NOT NULL"

SQL["quarantine_counts"] = f"WITH {FX1} SELECT reason, count(*) AS n FROM fx1 WHERE reason IS NOT NULL GROUP BY reason"

SQL["decode_nested_json"] = f"""WITH {FX1}
SELECT sample_id, decoded_from, 3 AS n_messages, 'developer,user,assistant' AS roles
FROM fx1 WHERE decoded_from IN ('string', 'repaired') AND reason IS NULL"""

SQL["repair_json_field"] = f"""WITH {FX1}
SELECT sample_id,
  '[{{"content":"@DEV@","role":"developer"}},{{"content":"' || ask
    || '","role":"user"}},{{"role":"assistant","tool_calls":[{{"function":{{"arguments":' || args_json
    || ',"name":"' || et || '"}}}}]}}]' AS repaired
FROM parts""".replace("@DEV@", DEVELOPER_TEXT)

# what is left of each broken message list, stated piece by piece
SQL["repair_json_structure"] = f"""WITH {FX1},
r AS (
  SELECT sample_id, sample_id % 8 AS v, '[{{"content":"@DEV@","role":"developer"}},{{"content":"' AS a, ask,
    '","role":"user"}},{{"role":"assistant","tool_calls":[{{"function":{{"arguments":' || args_json || ',"name":"' || et || '"}}}}]}}]' AS b
  FROM parts)
SELECT sample_id, CASE v
    WHEN 0 THEN a || substring(ask, 1, length(ask) - 4) || '","role":"user"}}]'
    WHEN 4 THEN a || ask || '","role":"user"}},{{"role":"assistant","tool_calls":null}}]'
    WHEN 5 THEN a || ask || '","role":"user"}},{{"role":"assistant","tool_ca":null}}]'
    ELSE a || ask || b END AS repaired,
  CASE WHEN v = 7 THEN 'strict' ELSE 'structural' END AS kind
FROM r""".replace("@DEV@", DEVELOPER_TEXT)

SQL["unwrap_singleton"] = """SELECT event_id AS sample_id, 3 AS n_items,
  CASE WHEN event_id % 5 = 3 THEN 'ARRAY' ELSE 'OBJECT' END AS first_type FROM events"""

SQL["split_train"] = f"""WITH {FX1}
SELECT sample_id, meta AS split, head || '<start_of_turn>model' || chr(10) AS prompt,
       substring(head || last_seg, length(head) + length('<start_of_turn>model') + 2) AS completion
FROM ok WHERE meta = 'train'"""

SQL["split_eval"] = SQL["split_train"].replace("meta = 'train'", "meta = 'eval'")

SQL["split_counts"] = f"WITH {FX1} SELECT meta AS split, count(*) AS n FROM ok GROUP BY meta"

SQL["render_chat_full"] = f"WITH {FX1} SELECT sample_id, head || last_seg AS \"full\" FROM ok"

SQL["render_chat_prompt"] = f"""WITH {FX1}
SELECT sample_id, head || '<start_of_turn>model' || chr(10) AS prompt, true AS prefix_ok FROM ok"""

SQL["render_tool_template"] = f"""WITH {FX1}
SELECT sample_id, head || last_seg AS "full", head || '<start_of_turn>model' || chr(10) AS prompt,
       substring(last_seg, length('<start_of_turn>model') + 2) AS completion, true AS prefix_ok FROM ok"""

# Two template programs stated turn by turn. The second wants user and assistant turns to alternate behind a
# leading system turn; other conversations render as NULL.
_STRIP = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
SQL["render_template_programs"] = rf"""
WITH n AS (
  SELECT conv_id, role, regexp_replace(text, '^{_STRIP}|{_STRIP}$', '', 'g') AS body, text,
         row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS last_i,
         first_value(role) OVER w = 'system' AS has_system,
         first_value(regexp_replace(text, '^{_STRIP}|{_STRIP}$', '', 'g')) OVER w AS first_body
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
p AS (
  SELECT *, i - CASE WHEN has_system THEN 2 ELSE 1 END AS pos,
         '<|im_start|>' || role || chr(10) || body || '<|im_end|>' || chr(10) AS a FROM n),
q AS (
  SELECT *, pos < 0 OR (role = 'user') = (pos % 2 = 0) AS fits,
         CASE WHEN pos < 0 THEN '' WHEN role = 'user'
              THEN '[INST] ' || CASE WHEN pos = 0 AND has_system THEN '<<SYS>>' || first_body || '<</SYS>> ' ELSE '' END || body || ' [/INST]'
              ELSE ' ' || text || '</s>' END AS b FROM p),
c AS (
  SELECT conv_id, string_agg(a, '' ORDER BY i) AS chatml,
         coalesce(string_agg(a, '' ORDER BY i) FILTER (WHERE i < last_i), '') || '<|im_start|>assistant' || chr(10) AS chatml_prompt,
         max(CASE WHEN i = last_i THEN role END) = 'assistant' AS chatml_ok,
         CASE WHEN bool_and(fits) THEN '<s>' || string_agg(b, '' ORDER BY i) END AS inst,
         CASE WHEN coalesce(bool_and(fits) FILTER (WHERE i < last_i), true)
              THEN '<s>' || coalesce(string_agg(b, '' ORDER BY i) FILTER (WHERE i < last_i), '') END AS inst_prompt
  FROM q GROUP BY conv_id)
SELECT *, substring(inst, length(inst_prompt) + 1) AS inst_completion FROM c"""

SQL["assemble_messages"] = """
SELECT conv_id, count(*) AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
       md5(string_agg(text, chr(1) ORDER BY turn)) AS content_md5
FROM conversations GROUP BY conv_id"""

SQL["explode_messages"] = """
SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn)) - 1 AS turn, role, text
FROM conversations"""


# FX1b generations and an independent SQL statement of the extraction rules.
GEN = FX1 + """,
gen AS (
  SELECT m.model, p.sample_id,
    CASE ((p.sample_id // 8) + m.off) % 8
      WHEN 0 THEN '<start_function_call>call:' || et || '{' || pairs || '}<end_function_call>'
      WHEN 1 THEN '<start_function_call>call:open_' || et || '{' || pairs || '}<end_function_call>'
      WHEN 2 THEN '<start_function_call>call:' || et || '{k:<escape>' || CAST(k + 1 AS VARCHAR) || '<escape>'
                  || CASE WHEN p.sample_id % 3 = 0 THEN '' ELSE ',user:<escape>' || uid || '<escape>' END
                  || '}<end_function_call>'
      WHEN 3 THEN '<start_function_call>call:' || et || '<end_function_call>'
      WHEN 4 THEN 'I can not help with that.<end_of_turn>'
      WHEN 5 THEN '<start_function_call>call:open_' || et || '{' || pairs || '}<end_function_call>'
                  || '<start_function_call>call:' || et || '{' || pairs || '}<end_function_call>'
      WHEN 6 THEN '<start_function_call>call:' || et || '{'
                  || CASE WHEN p.sample_id % 3 = 0 THEN 'k:<escape>' || CAST(k AS VARCHAR) || '<escape>'
                          ELSE 'user:<escape>' || uid || '<escape>,k:<escape>' || CAST(k AS VARCHAR) || '<escape>' END
                  || '}<end_function_call>'
      ELSE '<start_function_call>call:' || et || '{k:<escape>0<escape>,' || pairs || '}<end_function_call>'
    END AS output
  FROM parts p CROSS JOIN (VALUES ('fine_tuned', 0), ('baseline', 1)) m(model, off)
  WHERE ((p.sample_id // 10) + m.off) % 7 <> 3
),
xc AS (
  SELECT model, sample_id, output,
    list_filter(regexp_extract_all(coalesce(output, ''), '<start_function_call>(.*?)<end_function_call>', 1, 's'),
                lambda c: starts_with(regexp_replace(c, '^\\s+', ''), 'call:') AND contains(c, '{')) AS calls
  FROM gen
),
xr AS (
  SELECT model, sample_id, i - 1 AS call_no, calls[i] AS raw
  FROM (SELECT *, unnest(range(1, len(calls) + 1)) AS i FROM xc)
),
xa AS (
  SELECT model, sample_id, call_no,
    regexp_replace(replace(split_part(raw, '{', 1), 'call:', ''), '^\\s+|\\s+$', '', 'g') AS name,
    regexp_replace(substring(raw, length(split_part(raw, '{', 1)) + 2), '^\\s+|\\s+$', '', 'g') AS a0
  FROM xr
),
xk AS (
  SELECT *,
    list_transform(regexp_extract_all(a1, '([^:,]*?):<escape>(.*?)<escape>', 1, 's'),
                   lambda t: regexp_replace(t, '^\\s+|\\s+$', '', 'g')) AS ks,
    regexp_extract_all(a1, '([^:,]*?):<escape>(.*?)<escape>', 2, 's') AS vs
  FROM (SELECT *, CASE WHEN ends_with(a0, '}') THEN substring(a0, 1, length(a0) - 1) ELSE a0 END AS a1 FROM xa)
),
calls AS (
  SELECT model, sample_id, call_no, name,
    '{' || coalesce(array_to_string(list_transform(
        list_sort(list_transform(list_filter(range(1, len(ks) + 1), lambda i: NOT list_contains(ks[i + 1:], ks[i])),
                                 lambda i: {'k': ks[i], 'v': vs[i]})),
        lambda p: to_json(p.k) || ':' || to_json(p.v)), ','), '') || '}' AS args_json
  FROM xk
),
outs AS (
  SELECT g.model, g.sample_id, g.output,
    CASE WHEN g.output IS NULL OR g.output = '' OR starts_with(g.output, '<start_function_call>') THEN NULL
         ELSE regexp_replace(replace(g.output, '<end_of_turn>', ''), '^\\s+|\\s+$', '', 'g') END AS output_text,
    coalesce((SELECT CAST(to_json(list(c.name ORDER BY c.call_no)) AS VARCHAR) FROM calls c
              WHERE c.model = g.model AND c.sample_id = g.sample_id), '[]') AS output_names,
    '[' || coalesce((SELECT string_agg(c.args_json, ',' ORDER BY c.call_no) FROM calls c
              WHERE c.model = g.model AND c.sample_id = g.sample_id), '') || ']' AS output_arguments
  FROM gen g
),
scored AS (
  SELECT o.model, o.sample_id, et || ' for user ' || uid AS "user",
    '["' || et || '"]' AS target_names, o.output_names,
    '[' || args_json || ']' AS target_arguments, o.output_arguments,
    CAST(NULL AS VARCHAR) AS target_text, o.output_text,
    ('["' || et || '"]') = o.output_names AS correct_names,
    ('[' || args_json || ']') = o.output_arguments AS correct_arguments
  FROM ok JOIN (
    SELECT m.model, ok.sample_id, coalesce(outs.output_names, '[]') AS output_names,
      coalesce(outs.output_arguments, '[]') AS output_arguments, outs.output_text
    FROM ok CROSS JOIN (VALUES ('fine_tuned'), ('baseline')) m(model)
    LEFT JOIN outs ON outs.model = m.model AND outs.sample_id = ok.sample_id) o USING (sample_id)
  WHERE ok.meta = 'eval'
)"""

SQL["extract_calls"] = f"WITH {GEN} SELECT model, sample_id, call_no, name, args_json FROM calls"

SQL["extract_text"] = f"WITH {GEN} SELECT model, sample_id, output_text FROM outs"

SQL["strip_prompt_prefix"] = f"WITH {GEN} SELECT g.model, g.sample_id, g.output AS model_output FROM gen g JOIN ok USING (sample_id)"

SQL["eval_targets"] = f"""WITH {FX1}
SELECT sample_id, et || ' for user ' || uid AS "user", '["' || et || '"]' AS target_names,
       '[' || args_json || ']' AS target_arguments, CAST(NULL AS VARCHAR) AS target_text
FROM ok WHERE meta = 'eval'"""

SQL["score_exact"] = f"""WITH {GEN}
SELECT model, sample_id, correct_names, correct_arguments, correct_names AND correct_arguments AS correct FROM scored"""

SQL["scored_frame"] = f"""WITH {GEN}
SELECT *, correct_names AND correct_arguments AS correct FROM scored"""

SQL["review_errors"] = f"""WITH {GEN}
SELECT model, sample_id, "user" AS prompt, target_names AS expected_names, target_arguments AS expected_arguments,
       output_names AS actual_names, output_arguments AS actual_arguments
FROM scored WHERE NOT (correct_names AND correct_arguments)"""

SQL["accuracy_by_model"] = f"""WITH {GEN}
SELECT model, round(avg(CASE WHEN correct_names AND correct_arguments THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       count(*) AS n
FROM scored GROUP BY model"""

SQL["align_generations"] = f"""WITH {GEN}
SELECT m.model, ok.sample_id, g.output IS NOT NULL AS has_output, length(g.output) AS output_chars
FROM ok CROSS JOIN (VALUES ('fine_tuned'), ('baseline')) m(model)
LEFT JOIN gen g ON g.sample_id = ok.sample_id AND g.model = m.model WHERE ok.meta = 'eval'"""

SQL["compare_models"] = f"""WITH {GEN},
w AS (SELECT sample_id,
        max(CASE WHEN model = 'fine_tuned' THEN (correct_names AND correct_arguments)::INT END) AS a,
        max(CASE WHEN model = 'baseline' THEN (correct_names AND correct_arguments)::INT END) AS b
      FROM scored GROUP BY sample_id)
SELECT sample_id, a = 1 AS correct_a, b = 1 AS correct_b,
  CASE WHEN a = 1 AND b = 1 THEN 'both' WHEN a = 1 THEN 'only_a' WHEN b = 1 THEN 'only_b' ELSE 'neither' END AS outcome
FROM w"""

# FX2 pairs: user turn followed by an assistant turn.
PAIRS = f"""
nx AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text,
         lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before
  FROM conversations
),
base AS (
  SELECT conv_id * 1000000 + turn AS sample_id, text AS prompt, next_text AS reference, coalesce(before, text) AS other
  FROM nx WHERE role = 'user' AND next_role = 'assistant'
),
raw AS (
  SELECT m.model, b.*, {h('b.sample_id')} AS bucket,
    CASE WHEN m.model = 'fine_tuned' THEN substring(other, 1, length(other) // 4) || ' '
           || substring(reference, length(reference) // 5 + 1, length(reference) // 2)
         ELSE other END AS p
  FROM base b CROSS JOIN (VALUES ('fine_tuned'), ('baseline')) m(model)
),
pairs AS (
  SELECT model, sample_id, prompt, reference, bucket,
    CASE WHEN bucket % 20 = 0 THEN '' WHEN bucket % 7 = 3 THEN replace(p, ' ', chr(160)) ELSE p END AS prediction
  FROM raw
)"""

# the rows that metrics score: some samples twice, each row under a number of its own
ROWS = PAIRS + """,
scored_rows AS (
  SELECT model, row_number() OVER (ORDER BY model, sample_id, copy) AS sample_id, prompt, reference, prediction
  FROM (SELECT *, 1 AS copy FROM pairs UNION ALL SELECT *, 2 AS copy FROM pairs WHERE bucket % 50 = 7)
)"""
# Python's white space
SPACE = "[\\x09-\\x0D\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"

SQL["pair_ref_pred"] = f"""WITH {PAIRS}
SELECT model, sample_id, length(reference) AS ref_chars, length(prediction) AS pred_chars FROM pairs"""


def _rouge_tok(x: str) -> str:
    return (f"list_filter(string_split(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'), ' '), "
            "lambda t: t <> '')")


def _bleu_tok(x: str) -> str:
    s = f"regexp_replace(coalesce({x}, ''), '{SPACE}+$', '')"
    for a, b in (("<skipped>", ""), ("-' || chr(10) || '", ""), ("' || chr(10) || '", " "),
                 ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        s = f"replace({s}, '{a}', '{b}')"
    s = f"(' ' || {s} || ' ')"
    for pat, rep in (("([{-~\\[-` -&(-+:-@/])", " \\1 "), ("([^0-9])([\\.,])", "\\1 \\2 "),
                     ("([\\.,])([^0-9])", " \\1 \\2"), ("([0-9])(-)", "\\1 \\2 ")):
        s = f"regexp_replace({s}, '{pat}', '{rep}', 'g')"
    return f"list_filter(regexp_split_to_array({s}, '{SPACE}+'), lambda t: t <> '')"


def _chars(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '{SPACE}+', '', 'g')"


def _word_grams(orders: str, sep: str = " ") -> str:
    return f"""
ng AS (
  SELECT model, sample_id, o.n, 1 AS side, array_to_string(pt[i:i + o.n - 1], '{sep}') AS gram
  FROM tok, (VALUES {orders}) o(n), LATERAL (SELECT unnest(range(1, len(pt) - o.n + 2)) AS i)
  UNION ALL
  SELECT model, sample_id, o.n, 2 AS side, array_to_string(rt[i:i + o.n - 1], '{sep}') AS gram
  FROM tok, (VALUES {orders}) o(n), LATERAL (SELECT unnest(range(1, len(rt) - o.n + 2)) AS i)
),
cnt AS (
  SELECT model, sample_id, n, gram, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS cp,
         sum(CASE WHEN side = 2 THEN 1 ELSE 0 END) AS cr
  FROM ng GROUP BY model, sample_id, n, gram
),
mt AS (SELECT model, sample_id, n, sum(least(cp, cr)) AS match FROM cnt GROUP BY model, sample_id, n)"""


def _cv(x: str) -> str:
    """Consonant/vowel pattern of a word: C and V, with y a vowel after a consonant."""
    e = f"regexp_replace(regexp_replace({x}, '[aeiou]', 'V', 'g'), '[^Vy]', 'C', 'g')"
    for _ in range(3):
        e = f"regexp_replace(regexp_replace({e}, '(^|V)y', '\\1C', 'g'), 'Cy', 'CV', 'g')"
    return e


M_POS, M_ONE, M_TWO = "regexp_matches(c, '^C*V+C')", "regexp_matches(c, '^C*V+C+V*$')", "regexp_matches(c, '^C*V+C+V+C')"
CVC = "(c = 'VC' OR regexp_matches(c, 'CVC$') AND NOT regexp_matches(r, '[wxy]$'))"


def _suffix_step(prev: str, name: str, table, cond: str) -> str:
    """Strip the longest matching suffix of ``w`` and put its replacement where ``cond`` holds for the rest."""
    table = sorted(table, key=lambda t: -len(t[0]))
    size = " ".join(f"WHEN ends_with(w, '{a}') THEN {len(a)}" for a, _ in table)
    rep = " ".join(f"WHEN ends_with(w, '{a}') THEN '{b}'" for a, b in table)
    return f"""
{name}_a AS (SELECT token, w, CASE {size} ELSE 0 END AS cut, CASE {rep} END AS rep FROM {prev}),
{name}_b AS (SELECT *, left(w, length(w) - cut) AS r FROM {name}_a),
{name}_c AS (SELECT *, {_cv('r')} AS c FROM {name}_b),
{name} AS (SELECT token, CASE WHEN cut > 0 AND {cond} THEN r || rep ELSE w END AS w FROM {name}_c)"""


# Porter's steps as public ROUGE packages run them (NLTK's extended variant), on words(token).
STEMS = f"""
irregular(token, stem) AS (VALUES ('skies', 'sky'), ('dying', 'die'), ('lying', 'lie'), ('tying', 'tie'), ('news', 'news'),
  ('innings', 'inning'), ('inning', 'inning'), ('outings', 'outing'), ('outing', 'outing'), ('cannings', 'canning'),
  ('canning', 'canning'), ('howe', 'howe'), ('proceed', 'proceed'), ('exceed', 'exceed'), ('succeed', 'succeed')),
s1a AS (
  SELECT token, CASE WHEN length(token) = 4 AND ends_with(token, 'ies') THEN left(token, 3)
    WHEN ends_with(token, 'sses') OR ends_with(token, 'ies') THEN left(token, length(token) - 2)
    WHEN ends_with(token, 'ss') THEN token WHEN ends_with(token, 's') THEN left(token, length(token) - 1) ELSE token END AS w
  FROM words WHERE length(token) > 3
),
s1b_a AS (
  SELECT token, w, CASE WHEN ends_with(w, 'ied') THEN 'ied' WHEN ends_with(w, 'eed') THEN 'eed'
    WHEN ends_with(w, 'ed') AND contains({_cv('left(w, length(w) - 2)')}, 'V') THEN 'ed'
    WHEN ends_with(w, 'ing') AND contains({_cv('left(w, length(w) - 3)')}, 'V') THEN 'ing' ELSE '' END AS suf FROM s1a
),
s1b_b AS (SELECT *, left(w, length(w) - length(suf)) AS r FROM s1b_a),
s1b_c AS (SELECT *, {_cv('r')} AS c FROM s1b_b),
s1b AS (
  SELECT token, CASE
    WHEN suf = '' THEN w
    WHEN suf = 'ied' THEN left(w, CASE WHEN length(w) = 4 THEN 3 ELSE length(w) - 2 END)
    WHEN suf = 'eed' THEN CASE WHEN {M_POS} THEN left(w, length(w) - 1) ELSE w END
    WHEN regexp_matches(r, '(at|bl|iz)$') THEN r || 'e'
    WHEN length(r) > 1 AND right(r, 1) = left(right(r, 2), 1) AND ends_with(c, 'C')
      THEN CASE WHEN regexp_matches(r, '[lsz]$') THEN r ELSE left(r, length(r) - 1) END
    WHEN {M_ONE} AND {CVC} THEN r || 'e' ELSE r END AS w FROM s1b_c
),
s1c AS (
  SELECT token, CASE WHEN ends_with(w, 'y') AND length(w) > 2 AND ends_with({_cv('left(w, length(w) - 1)')}, 'C')
    THEN left(w, length(w) - 1) || 'i' ELSE w END AS w FROM s1b
),
{_suffix_step('s1c', 's2l', [('logi', 'log')], M_POS.replace('c,', _cv("(r || 'l')") + ',')).strip()},
{_suffix_step("(SELECT token, CASE WHEN ends_with(w, 'logi') THEN w || '.' ELSE w END AS w FROM s2l)", 's2x', [
    ('ational', 'ate'), ('tional', 'tion'), ('enci', 'ence'), ('anci', 'ance'), ('izer', 'ize'), ('bli', 'ble'), ('alli', 'al'),
    ('entli', 'ent'), ('eli', 'e'), ('ousli', 'ous'), ('ization', 'ize'), ('ation', 'ate'), ('ator', 'ate'), ('alism', 'al'),
    ('iveness', 'ive'), ('fulness', 'ful'), ('ousness', 'ous'), ('aliti', 'al'), ('iviti', 'ive'), ('biliti', 'ble'),
    ('fulli', 'ful')], M_POS).strip()},
s2 AS (SELECT token, rtrim(w, '.') AS w FROM s2x),
{_suffix_step('s2', 's3', [('icate', 'ic'), ('ative', ''), ('alize', 'al'), ('iciti', 'ic'), ('ical', 'ic'), ('ful', ''),
                          ('ness', '')], M_POS).strip()},
{_suffix_step('s3', 's4', [(x, '') for x in ('al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize'
                                            ).split()], M_TWO + " AND (NOT ends_with(w, 'ion') OR regexp_matches(r, '[st]$'))").strip()},
{_suffix_step('s4', 's5a', [('e', '')], f"({M_TWO} OR {M_ONE} AND NOT {CVC})").strip()},
s5b AS (SELECT token, w, {_cv('w')} AS c FROM s5a),
stems AS (
  SELECT words.token, coalesce(irregular.stem, CASE WHEN ends_with(w, 'll') AND {M_TWO} THEN left(w, length(w) - 1) ELSE w END,
                               words.token) AS stem
  FROM words LEFT JOIN irregular USING (token) LEFT JOIN s5b USING (token)
)"""

SQL["stem_vocabulary"] = f"""WITH {PAIRS},
words AS (
  SELECT DISTINCT token FROM (SELECT unnest({_rouge_tok('prediction')}) AS token FROM pairs
                              UNION ALL SELECT unnest({_rouge_tok('reference')}) FROM pairs)),
{STEMS}
SELECT token, stem FROM stems"""

PLAIN_TOK = f"""tok AS (
  SELECT model, sample_id, {_rouge_tok('prediction')} AS pt, {_rouge_tok('reference')} AS rt FROM scored_rows)"""


def _stem_list(col: str) -> str:
    return f"""(SELECT sample_id, list(stem ORDER BY i) AS l
    FROM (SELECT sample_id, unnest({col}) AS token, generate_subscripts({col}, 1) AS i FROM tok0) JOIN stems USING (token) GROUP BY 1)"""


STEMMED_TOK = f"""{PLAIN_TOK.replace('tok AS', 'tok0 AS')},
words AS (SELECT DISTINCT token FROM (SELECT unnest(pt) AS token FROM tok0 UNION ALL SELECT unnest(rt) FROM tok0)),
{STEMS},
tok AS (
  SELECT t.model, t.sample_id, coalesce(p.l, []::VARCHAR[]) AS pt, coalesce(r.l, []::VARCHAR[]) AS rt
  FROM tok0 t LEFT JOIN {_stem_list('pt')} p USING (sample_id) LEFT JOIN {_stem_list('rt')} r USING (sample_id))"""

ROUGE_N = f"""WITH {ROWS},
{PLAIN_TOK},
{_word_grams('(1), (2)')},
per AS (
  SELECT t.model, t.sample_id, o.n, greatest(len(t.pt) - o.n + 1, 0) AS hyp, greatest(len(t.rt) - o.n + 1, 0) AS ref,
         coalesce(mt.match, 0) AS match
  FROM tok t CROSS JOIN (VALUES (1), (2)) o(n) LEFT JOIN mt ON mt.model = t.model AND mt.sample_id = t.sample_id AND mt.n = o.n
),
f AS (SELECT model, n, match / greatest(hyp, 1) AS p, match / greatest(ref, 1) AS r FROM per)
SELECT model, 'rouge_rouge' || CAST(n AS VARCHAR) AS metric,
       round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END), 6) AS value
FROM f GROUP BY model, n"""
SQL["rouge_n"] = ROUGE_N
ROUGE_N_STEMMED = ROUGE_N.replace(PLAIN_TOK, STEMMED_TOK)
SQL["rouge_n_stemmed"] = ROUGE_N_STEMMED

BLEU = f"""WITH {ROWS},
tok AS (SELECT model, sample_id, {_bleu_tok('prediction')} AS pt, {_bleu_tok('reference')} AS rt FROM scored_rows),
{_word_grams('(1), (2), (3), (4)')},
ms AS (SELECT model, n, sum(match) AS match FROM mt GROUP BY model, n),
tot AS (
  SELECT model, o.n, sum(greatest(len(pt) - o.n + 1, 0)) AS total
  FROM tok, (VALUES (1), (2), (3), (4)) o(n) GROUP BY model, o.n
),
lens AS (SELECT model, sum(len(pt)) AS sys_len, sum(len(rt)) AS ref_len FROM tok GROUP BY model),
st AS (
  SELECT t.model, t.n, t.total, coalesce(ms.match, 0) AS match,
         sum(CASE WHEN coalesce(ms.match, 0) = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY t.model ORDER BY t.n) AS k
  FROM tot t LEFT JOIN ms ON ms.model = t.model AND ms.n = t.n
),
agg AS (
  SELECT model, max(match) AS any_match, min(total) AS min_total,
         sum(ln(CASE WHEN total = 0 THEN 1.0 WHEN match > 0 THEN match / total ELSE 1.0 / (pow(2, k) * total) END)) AS ls
  FROM st GROUP BY model
)
SELECT a.model, 'bleu' AS metric,
  round(CASE WHEN a.any_match = 0 OR a.min_total = 0 THEN 0.0
        ELSE (CASE WHEN l.sys_len >= l.ref_len THEN 1.0 WHEN l.sys_len > 0 THEN exp(1 - l.ref_len / l.sys_len) ELSE 0.0 END)
             * exp(a.ls / 4) END, 6) AS value
FROM agg a JOIN lens l USING (model)"""
SQL["bleu_corpus"] = BLEU

CHRF = f"""WITH {ROWS},
tok AS (SELECT model, sample_id, {_chars('prediction')} AS ps, {_chars('reference')} AS rs FROM scored_rows),
ng AS (
  SELECT model, sample_id, o.n, 1 AS side, substring(ps, i, o.n) AS gram
  FROM tok, (VALUES (1), (2), (3), (4), (5), (6)) o(n), LATERAL (SELECT unnest(range(1, length(ps) - o.n + 2)) AS i)
  UNION ALL
  SELECT model, sample_id, o.n, 2 AS side, substring(rs, i, o.n) AS gram
  FROM tok, (VALUES (1), (2), (3), (4), (5), (6)) o(n), LATERAL (SELECT unnest(range(1, length(rs) - o.n + 2)) AS i)
),
cnt AS (
  SELECT model, sample_id, n, gram, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS cp,
         sum(CASE WHEN side = 2 THEN 1 ELSE 0 END) AS cr
  FROM ng GROUP BY model, sample_id, n, gram
),
seg AS (SELECT model, sample_id, n, sum(cp) AS hyp, sum(cr) AS ref, sum(least(cp, cr)) AS match
        FROM cnt GROUP BY model, sample_id, n),
st AS (SELECT model, n, sum(CASE WHEN ref > 0 THEN hyp ELSE 0 END) AS hyp, sum(ref) AS ref, sum(match) AS match
       FROM seg GROUP BY model, n),
pr AS (
  SELECT model,
    sum(CASE WHEN hyp > 0 AND ref > 0 THEN match / hyp ELSE 0 END) AS sp,
    sum(CASE WHEN hyp > 0 AND ref > 0 THEN match / ref ELSE 0 END) AS sr,
    sum(CASE WHEN hyp > 0 AND ref > 0 THEN 1 ELSE 0 END) AS eff
  FROM st GROUP BY model
),
pr2 AS (SELECT model, CASE WHEN eff > 0 THEN sp / eff ELSE 0 END AS p, CASE WHEN eff > 0 THEN sr / eff ELSE 0 END AS r FROM pr)
SELECT model, 'chrf' AS metric, round(CASE WHEN p + r > 0 THEN 5 * p * r / (4 * p + r) ELSE 0.0 END, 6) AS value
FROM pr2"""
SQL["chrf_corpus"] = CHRF

SQL["embedding_match"] = """
WITH tv AS (
  SELECT vec_id // 16 AS sample_id, CASE WHEN vec_id % 2 = 0 THEN 'pred' ELSE 'ref' END AS side,
         (vec_id % 16) // 2 AS pos, CAST(embedding AS DOUBLE[]) AS e
  FROM embeddings
),
un AS (
  SELECT sample_id, side, pos,
         list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS u
  FROM tv
),
best AS (
  SELECT a.sample_id, a.side, a.pos, max(list_dot_product(a.u, b.u)) AS b
  FROM un a JOIN un b ON a.sample_id = b.sample_id AND a.side <> b.side
  GROUP BY a.sample_id, a.side, a.pos
),
pr AS (
  SELECT sample_id, avg(CASE WHEN side = 'pred' THEN b END) AS p, avg(CASE WHEN side = 'ref' THEN b END) AS r
  FROM best GROUP BY sample_id
)
SELECT sample_id, round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1
FROM pr"""


# FX4 configs and the registry, through DuckDB's json_tree. Equality and matching are
# stated on node rows: a stored config matches a request when every (path, value) of the
# request (outside the exceptions) is found in it.
CFG_DEPTH = 11
CFG = f"""
cfg0 AS (
  SELECT event_id AS config_id, event_type, event_id % 24 AS v,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    '{{"FROM": "' || event_type || '"' AS head,
    ', "Model": {{"name": "m' || CAST(user_id % 5 AS VARCHAR) || '", "opt": {{"k": '
      || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 AS VARCHAR) || '}}}}' AS model,
    ', "NumEpochs": ' || CAST((CAST(floor(value) AS BIGINT) % 3) + 1 AS VARCHAR) AS epochs
  FROM events
),
cfg AS (
  SELECT config_id, event_type,
    CASE v WHEN 3 THEN NULL WHEN 7 THEN '{{}}' WHEN 11 THEN head WHEN 13 THEN '[' || (k % 4) || ']'
      WHEN 15 THEN head || '}}'
      WHEN 17 THEN head || model || epochs || ', "Tags": ["x", 1, null]}}'
      WHEN 19 THEN head || epochs || '{"".join(f', "d{i}": {{{{"a": {i}' for i in range(1, CFG_DEPTH)).replace("{{", "{")}'
        || ', "end": ' || (k % 2) || '{"}" * (CFG_DEPTH - 1)}}}'
      ELSE head || model || epochs || '}}' END AS config
  FROM cfg0
),
st AS (
  SELECT *, CASE WHEN config IS NULL THEN 'null' WHEN NOT json_valid(config) THEN 'invalid_json'
                 WHEN json_type(config) <> 'OBJECT' THEN 'not_object' ELSE 'ok' END AS status FROM cfg
),
nodes AS (
  SELECT c.config_id, c.event_type, replace(substring(t.fullkey, 3), '.', '/') AS path,
    length(t.fullkey) - length(replace(t.fullkey, '.', '')) AS depth,
    CASE t.type WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' ELSE t.type END AS kind,
    CAST(t.value AS VARCHAR) AS value_json
  FROM (SELECT * FROM st WHERE status = 'ok') c, json_tree(c.config) t
  WHERE t.fullkey <> '$' AND NOT contains(t.fullkey, '[')
)"""


def _no_except(keys) -> str:
    return " AND ".join(f"NOT (path = '{k}' OR starts_with(path, '{k}/'))" for k in keys)


SQL["json_key_paths"] = f"""WITH {CFG}
SELECT st.config_id, status, path, depth, kind, value_json FROM st LEFT JOIN nodes USING (config_id)"""

SQL["json_delete_path"] = f"""WITH {CFG},
left_over AS (
  SELECT config_id, path, value_json FROM nodes n
  WHERE NOT EXISTS (
    SELECT 1 FROM nodes t WHERE t.config_id = n.config_id AND t.path = 'Model/opt/k'
      AND t.value_json NOT IN ('0', '0.0', '""', 'false', 'null', '{{}}', '[]')
      AND (n.path = 'Model/opt/k' OR starts_with(n.path, 'Model/opt/k/'))))
SELECT st.config_id, path, value_json FROM st LEFT JOIN left_over USING (config_id)"""

SQL["json_prune"] = f"""WITH {CFG},
kept AS (
  SELECT config_id, path, value_json FROM nodes
  WHERE path IN (SELECT path FROM nodes WHERE config_id = 0) AND {_no_except(('NumEpochs',))})
SELECT st.config_id, path, value_json FROM st LEFT JOIN kept USING (config_id)"""

KEPT = f"""{CFG},
kept AS (
  SELECT config_id, event_type, path, kind || ':' || CASE WHEN kind = 'OBJECT' THEN '' ELSE value_json END AS val
  FROM nodes WHERE {_no_except(('NumEpochs', 'Model/opt/k'))}
)"""

SQL["config_identical"] = f"""WITH {KEPT},
base AS (SELECT path, val FROM kept WHERE config_id = 0),
same AS (SELECT k.config_id, count(*) AS n FROM kept k JOIN base b ON b.path = k.path AND b.val = k.val GROUP BY 1)
SELECT st.config_id, status,
  status = 'ok' AND coalesce(same.n, 0) = (SELECT count(*) FROM base) AS identical
FROM st LEFT JOIN same USING (config_id)"""

REG = f"""{KEPT},
tree AS (
  SELECT st.config_id, event_type, coalesce(t, '') AS tree, coalesce(n, 0) AS n
  FROM st LEFT JOIN (SELECT config_id, string_agg(path || '=' || val, ';' ORDER BY path) AS t, count(*) AS n
                     FROM kept GROUP BY config_id) USING (config_id)
  WHERE status = 'ok'
),
req AS (SELECT tree, any_value(n) AS n, min(config_id) AS one FROM tree GROUP BY tree),
sto AS (SELECT tree, min(config_id) AS run_id, count(*) AS times, min(config_id) AS one FROM tree
        WHERE event_type = 'view' GROUP BY tree),
shared AS (
  SELECT req.tree AS r, sto.tree AS s, count(*) AS n
  FROM req JOIN kept a ON a.config_id = req.one JOIN kept b ON b.path = a.path AND b.val = a.val
  JOIN sto ON sto.one = b.config_id GROUP BY 1, 2
),
hit AS (
  SELECT r AS tree, min(run_id) AS matched_run, sum(times) AS n_matches
  FROM (SELECT shared.r, sto.run_id, sto.times FROM shared JOIN req ON req.tree = shared.r AND req.n = shared.n
        JOIN sto ON sto.tree = shared.s
        UNION ALL SELECT req.tree, sto.run_id, sto.times FROM req, sto WHERE req.n = 0) GROUP BY r
),
m AS (
  SELECT st.config_id, st.status, tree.tree, matched_run, coalesce(n_matches, 0)::BIGINT AS n_matches
  FROM st LEFT JOIN tree USING (config_id) LEFT JOIN hit ON hit.tree = tree.tree
)"""

SQL["registry_match"] = f"WITH {REG} SELECT config_id, status, matched_run, n_matches FROM m"

SQL["assign_run_slot"] = f"""WITH {REG},
nw AS (SELECT tree, min(config_id) AS first_id FROM m WHERE status = 'ok' AND matched_run IS NULL GROUP BY tree),
nn AS (SELECT tree, (SELECT max(config_id) FROM st WHERE event_type = 'view') + row_number() OVER (ORDER BY first_id) AS new_run
       FROM nw)
SELECT m.config_id, m.status, coalesce(m.matched_run, nn.new_run) AS run_id, m.matched_run IS NOT NULL AS reused
FROM m LEFT JOIN nn ON nn.tree = m.tree"""

# which tree holds all entries of which; first and second round of new slots, in the order of the first request
SQL["register_runs"] = f"""WITH {KEPT},
tree AS (
  SELECT st.config_id, coalesce(t, '') AS tree, coalesce(n, 0) AS n
  FROM st LEFT JOIN (SELECT config_id, string_agg(path || '=' || val, ';' ORDER BY path) AS t, count(*) AS n
                     FROM kept GROUP BY config_id) USING (config_id) WHERE status = 'ok'),
u AS (SELECT tree, any_value(n) AS n, min(config_id) AS f2, min(config_id) FILTER (WHERE config_id % 2 = 0) AS f1 FROM tree GROUP BY tree),
holds AS (
  SELECT r, s FROM (
    SELECT a.tree AS r, b.tree AS s, any_value(a.n) AS n, count(*) AS both_have
    FROM u a JOIN kept x ON x.config_id = a.f2 JOIN kept y ON y.path = x.path AND y.val = x.val JOIN u b ON b.f2 = y.config_id
    GROUP BY 1, 2) WHERE n = both_have
  UNION ALL SELECT a.tree, b.tree FROM u a, u b WHERE a.n = 0),
own1 AS (SELECT r AS tree, min(b.f1) AS first_id FROM holds JOIN u a ON a.tree = r AND a.f1 IS NOT NULL
         JOIN u b ON b.tree = s WHERE b.f1 IS NOT NULL GROUP BY r),
run1 AS (SELECT u.tree, row_number() OVER (ORDER BY f1) AS run_id FROM own1 JOIN u ON u.tree = own1.tree AND u.f1 = first_id),
rest AS (SELECT * FROM u WHERE tree NOT IN (SELECT r FROM holds JOIN run1 ON run1.tree = s)),
own2 AS (SELECT r AS tree, min(b.f2) AS first_id FROM holds JOIN rest a ON a.tree = r JOIN rest b ON b.tree = s GROUP BY r),
run2 AS (SELECT u.tree, (SELECT max(run_id) FROM run1) + row_number() OVER (ORDER BY f2) AS run_id
         FROM own2 JOIN u ON u.tree = own2.tree AND u.f2 = first_id),
slot AS (SELECT r AS tree, min(run_id) AS run_id FROM holds
         JOIN (SELECT * FROM run1 UNION ALL SELECT * FROM run2) q ON q.tree = s GROUP BY r)
SELECT st.config_id, st.status, run_id::BIGINT AS run_id, run_id IS NOT NULL AS reused
FROM st LEFT JOIN tree USING (config_id) LEFT JOIN slot ON slot.tree = tree.tree"""

SQL["config_overlay"] = f"""WITH {CFG},
top AS (SELECT c.config_id, c.event_type, j.key, CAST(j.value AS VARCHAR) AS value_json
        FROM (SELECT * FROM st WHERE status = 'ok') c, json_each(c.config) j)
SELECT event_type, key, arg_max(value_json, config_id) AS value_json FROM top GROUP BY event_type, key"""


# ---------------------------------------------------------------- sampling
SQL["shuffle_seeded"] = f"""WITH {FX1}
SELECT sample_id, row_number() OVER (ORDER BY md5(CAST(sample_id AS VARCHAR) || '|42'), sample_id) - 1 AS rank FROM fx1"""

SQL["sample_rows"] = f"""WITH {FX1}
SELECT sample_id, text FROM fx1 ORDER BY md5(CAST(sample_id AS VARCHAR) || '|42'), sample_id LIMIT 5"""

SQL["sample_fraction"] = f"""WITH {FX1}
SELECT sample_id, text FROM fx1
WHERE ('0x' || substr(md5(CAST(sample_id AS VARCHAR) || '|42'), 1, 8))::BIGINT < floor(0.05 * 4294967296)"""

PREP = FX1 + """,
prep AS (
  SELECT sample_id, meta AS split, head || '<start_of_turn>model' || chr(10) AS prompt,
         substring(head || last_seg, length(head) + length('<start_of_turn>model') + 2) AS completion
  FROM ok
)"""

SQL["longest_example"] = f"""WITH {PREP}
SELECT sample_id, length(prompt) + length(completion) AS n_chars FROM prep
ORDER BY length(prompt) + length(completion) DESC, sample_id LIMIT 1"""

SQL["max_sequence_length"] = f"""WITH {PREP},
best AS (SELECT * FROM prep ORDER BY length(prompt) + length(completion) DESC, sample_id LIMIT 1),
t AS (SELECT *, len(list_filter(regexp_split_to_array(prompt || completion, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS nt
      FROM best)
SELECT sample_id, length(prompt) + length(completion) AS n_chars, nt AS n_tokens, nt + 100 AS max_length FROM t"""

SQL["cap_eval"] = f"WITH {PREP} SELECT sample_id, prompt FROM prep WHERE split = 'eval' ORDER BY sample_id LIMIT 100"

# ---------------------------------------------------------------- prompt lines (Python json.dumps escaping)
def escape_sql(x: str) -> str:
    """Python ``json.dumps(x)[1:-1]`` (ensure_ascii) in DuckDB, character by character."""
    return f"""
  CASE WHEN {x} = '' THEN '' ELSE array_to_string(list_transform(string_split({x}, ''), lambda ch:
    CASE WHEN ch = '\\' THEN '\\\\' WHEN ch = '"' THEN '\\"'
         WHEN ch = chr(10) THEN '\\n' WHEN ch = chr(13) THEN '\\r' WHEN ch = chr(9) THEN '\\t'
         WHEN ch = chr(8) THEN '\\b' WHEN ch = chr(12) THEN '\\f'
         WHEN unicode(ch) < 32 THEN printf('\\u%04x', unicode(ch))
         WHEN unicode(ch) <= 127 THEN ch
         WHEN unicode(ch) < 65536 THEN printf('\\u%04x', unicode(ch))
         ELSE printf('\\u%04x', 55296 + ((unicode(ch) - 65536) >> 10)) || printf('\\u%04x', 56320 + ((unicode(ch) - 65536) & 1023))
    END), '') END"""


PLINES = f"""
pl AS (
  SELECT item_id, line_no,
    CASE item_id % 4 WHEN 1 THEN '"' || line || '"' WHEN 2 THEN chr(9) || '  ' || line || ' ' || chr(9)
                     WHEN 3 THEN '   ' ELSE line END AS line
  FROM (SELECT item_id, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line_no,
               unnest(string_split(text, chr(10))) AS line FROM benchmark)
),
pe AS (
  SELECT item_id, line_no, {escape_sql("regexp_replace(line, '^\\s+|\\s+$', '', 'g')")} AS user_prompt,
         length(regexp_replace(line, '^\\s+|\\s+$', '', 'g')) = 0 AS rejected
  FROM pl
)"""

SQL["prompt_file"] = f"WITH {PLINES} SELECT user_prompt, rejected FROM pe"

SQL["prompt_lines_escaped"] = f"WITH {PLINES} SELECT item_id, line_no, user_prompt, rejected FROM pe"

FIRST_TOOLS = f"(SELECT tools FROM ok ORDER BY sample_id LIMIT 1)"

SQL["attach_tools"] = f"""WITH {FX1}, {PLINES}
SELECT item_id, line_no, {FIRST_TOOLS} AS tools_json FROM pe WHERE NOT rejected"""

SQL["render_adhoc_prompts"] = f"""WITH {FX1}, {PLINES}
SELECT item_id, line_no,
  '<start_of_turn>developer' || chr(10) || '<tools>' || {FIRST_TOOLS} || '</tools><end_of_turn>' || chr(10)
  || '<start_of_turn>developer' || chr(10)
  || '{DEVELOPER_FIXED}'
  || '<end_of_turn>' || chr(10) || '<start_of_turn>user' || chr(10) || user_prompt || '<end_of_turn>' || chr(10)
  || '<start_of_turn>model' || chr(10) AS prompt
FROM pe WHERE NOT rejected"""

def _text(x: str) -> str:
    """A SQL string of ``x`` with its line breaks as chr(10)."""
    return " || chr(10) || ".join(f"'{part}'" for part in x.split("\n"))


SQL["render_time_context"] = f"""
WITH t AS (SELECT event_id, ts, timezone('America/Toronto', timezone('UTC', ts)) AS loc FROM events)
SELECT event_id,
  {_text(DEVELOPER_CLOCK_INTRO + CLOCK_FORMAT_INTRO)} || strftime(loc, '%Y-%m-%dT%H:%M:%S') || ' '
  || CASE WHEN date_diff('minute', ts, loc) = -240 THEN 'EDT' ELSE 'EST' END
  || {_text(CLOCK_DAY)} || dayname(loc) AS developer_content
FROM t"""

# ---------------------------------------------------------------- sinks
SQL["export_csv_roundtrip"] = f"WITH {PREP} SELECT sample_id AS row_id, split, prompt, completion FROM prep"

SQL["scored_json_roundtrip"] = SQL["scored_frame"]

# ---------------------------------------------------------------- generation & judge
SQL["batch_generate"] = f"""WITH {FX1}
SELECT sample_id, '<start_function_call>call:' || et || '{{user:<escape>' || uid || '<escape>}}<end_function_call>' AS output
FROM ok WHERE meta = 'eval'"""

JPROMPT = """'## User prompt' || chr(10) || prompt || chr(10) || chr(10) || '## Reference (ground truth) completion' || chr(10)
  || reference || chr(10) || chr(10) || '## Model completion to score' || chr(10) || prediction || chr(10) || chr(10)
  || '## Task' || chr(10) || 'Score the model completion from 0 to 10 for each criterion: accuracy, relevance, tone.'
  || chr(10) || 'Output only a JSON object with keys: ["accuracy", "relevance", "tone"]. One number per key.'"""

SQL["judge_prompt"] = f"WITH {PAIRS} SELECT model, sample_id, {JPROMPT} AS judge_prompt FROM pairs"

SQL["judge_batch"] = f"""WITH {PAIRS}
SELECT model, sample_id, CAST(length(prediction) % 11 AS DOUBLE) AS accuracy,
       CAST(length(reference) % 11 AS DOUBLE) AS relevance, CAST(length(prompt) % 11 AS DOUBLE) AS tone, false AS failed
FROM pairs"""

SQL["judge_resume"] = SQL["judge_batch"].replace("false AS failed", "false AS failed, 1::BIGINT AS times_sent")

FX5 = """
jr AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN 'fine_tuned' ELSE 'baseline' END AS model, event_id AS sample_id,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id % 9 AS c
  FROM events
),
rep AS (
  SELECT model, sample_id,
    CASE c
      WHEN 0 THEN '{"accuracy": ' || (k % 11) || ', "relevance": ' || ((k + 3) % 11) || ', "tone": ' || ((k + 7) % 11) || '}'
      WHEN 1 THEN 'Here you go:' || chr(10) || '```json' || chr(10) || '{"accuracy": ' || (k % 11) || ', "relevance": ' || ((k + 3) % 11) || ', "tone": ' || ((k + 7) % 11) || '}' || chr(10) || '```'
      WHEN 2 THEN '```' || chr(10) || '{"accuracy": ' || (k % 11) || ', "relevance": ' || ((k + 3) % 11) || ', "tone": ' || ((k + 7) % 11) || '}' || chr(10) || '```' || chr(10) || 'Done.'
      WHEN 3 THEN 'The completion looks fine to me.'
      WHEN 4 THEN '{"accuracy": ' || (k % 11) || ', "relevance": ' || ((k + 3) % 11) || '}'
      WHEN 5 THEN '{"accuracy": "' || (k % 11) || '", "relevance": ' || ((k + 3) % 11) || ', "tone": ' || ((k + 7) % 11) || '}'
      WHEN 6 THEN '{"accuracy": ' || (k % 11) || ', "relevance": null, "tone": ' || ((k + 7) % 11) || '}'
      WHEN 7 THEN '[' || (k % 11) || ', ' || ((k + 3) % 11) || ', ' || ((k + 7) % 11) || ']'
      ELSE '{"accuracy": ' || ((k % 11) + 10) || ', "relevance": ' || ((k + 3) % 11) || ', "tone": ' || ((k + 7) % 11) || '}'
    END AS reply
  FROM jr
),
seg AS (
  SELECT model, sample_id,
    CASE WHEN starts_with(s0, 'json') THEN substring(s0, 5) ELSE s0 END AS s
  FROM (SELECT *, CASE WHEN contains(reply, '```') THEN string_split(reply, '```')[2] ELSE reply END AS s0 FROM rep)
),
crit AS (
  SELECT model, sample_id, s, coalesce(CASE WHEN json_valid(s0) THEN json_type(s0) END = 'OBJECT', false) AS obj,
    json_type(s1, '$.accuracy') AS ta, json_type(s1, '$.relevance') AS tr, json_type(s1, '$.tone') AS tt,
    json_extract_string(s1, '$.accuracy') AS va, json_extract_string(s1, '$.relevance') AS vr, json_extract_string(s1, '$.tone') AS vt
  FROM (SELECT *, s AS s0, CASE WHEN coalesce(CASE WHEN json_valid(s) THEN json_type(s) END = 'OBJECT', false) THEN s ELSE '{}' END AS s1 FROM seg)
),
num AS (
  SELECT *,
    CASE WHEN ta IS NULL THEN 0.0 WHEN ta = 'BOOLEAN' THEN CASE WHEN va = 'true' THEN 1.0 ELSE 0.0 END
         WHEN ta IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'VARCHAR') THEN TRY_CAST(va AS DOUBLE) END AS na,
    CASE WHEN tr IS NULL THEN 0.0 WHEN tr = 'BOOLEAN' THEN CASE WHEN vr = 'true' THEN 1.0 ELSE 0.0 END
         WHEN tr IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'VARCHAR') THEN TRY_CAST(vr AS DOUBLE) END AS nr,
    CASE WHEN tt IS NULL THEN 0.0 WHEN tt = 'BOOLEAN' THEN CASE WHEN vt = 'true' THEN 1.0 ELSE 0.0 END
         WHEN tt IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'VARCHAR') THEN TRY_CAST(vt AS DOUBLE) END AS nt
  FROM crit
),
parsed AS (
  SELECT model, sample_id, NOT obj OR na IS NULL OR nr IS NULL OR nt IS NULL AS failed,
    CASE WHEN NOT obj OR na IS NULL OR nr IS NULL OR nt IS NULL THEN 0.0 ELSE na END AS accuracy,
    CASE WHEN NOT obj OR na IS NULL OR nr IS NULL OR nt IS NULL THEN 0.0 ELSE nr END AS relevance,
    CASE WHEN NOT obj OR na IS NULL OR nr IS NULL OR nt IS NULL THEN 0.0 ELSE nt END AS tone
  FROM num
)"""

SQL["judge_parse"] = f"WITH {FX5} SELECT model, sample_id, accuracy, relevance, tone, failed FROM parsed"

SQL["judge_parse_strict"] = """
WITH e AS (SELECT event_id AS sample_id, event_id % 7 AS v, CAST(json_extract_string(props, '$.k') AS BIGINT) % 11 AS k FROM events)
SELECT sample_id, CASE WHEN v IN (1, 6) THEN k::DOUBLE WHEN v = 2 THEN 3.0 ELSE 0.0 END AS accuracy,
       CASE WHEN v IN (1, 2, 6) THEN 4.0::DOUBLE ELSE 0.0 END AS relevance, CASE WHEN v IN (1, 2, 6) THEN 2.0::DOUBLE ELSE 0.0 END AS tone,
       v NOT IN (1, 2, 6) AS failed FROM e"""

SQL["record_acceptance"] = """
SELECT event_id AS sample_id, CASE WHEN event_id % 6 IN (2, 3, 4) THEN 'invalid_json' WHEN event_id % 6 = 5 THEN 'duplicate_key' END AS reason,
       CASE WHEN event_id % 6 IN (0, 1) THEN 'train' END AS split FROM events"""

SQL["judge_aggregate"] = f"""WITH {FX5},
a AS (SELECT model, avg(accuracy) AS a, avg(relevance) AS r, avg(tone) AS t, sum(failed::INT) AS n_failed
      FROM parsed GROUP BY model)
SELECT model, 'judge_accuracy' AS metric, round(a, 6) AS value, n_failed FROM a
UNION ALL SELECT model, 'judge_relevance', round(r, 6), n_failed FROM a
UNION ALL SELECT model, 'judge_tone', round(t, 6), n_failed FROM a"""

# ROUGE-L: LCS by a recursive CTE over reference tokens. Row i of the DP table is
# L[i][j] = max over k <= j of (a_i = b_k ? L[i-1][k-1] + 1 : L[i-1][k]), i.e. a
# running max over j of a value built from the previous row with lag().
ROUGE_L = f"""WITH RECURSIVE {ROWS},
{PLAIN_TOK},
bt AS (
  SELECT model, sample_id, j, CASE WHEN j = 0 THEN NULL ELSE pt[j] END AS b, len(rt) AS n
  FROM tok, LATERAL (SELECT unnest(range(0, len(pt) + 1)) AS j)
  WHERE len(rt) > 0 AND len(pt) > 0
),
rtok AS (
  SELECT model, sample_id, i, rt[i] AS a
  FROM tok, LATERAL (SELECT unnest(range(1, len(rt) + 1)) AS i)
  WHERE len(rt) > 0 AND len(pt) > 0
),
dp AS (
  SELECT model, sample_id, 0 AS i, j, b, n, 0 AS v FROM bt
  UNION ALL
  SELECT model, sample_id, i, j, b, n,
         max(w) OVER (PARTITION BY model, sample_id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v
  FROM (
    SELECT d.model, d.sample_id, d.i + 1 AS i, d.j, d.b, d.n,
      CASE WHEN d.j = 0 THEN 0
           WHEN rtok.a = d.b THEN lag(d.v) OVER (PARTITION BY d.model, d.sample_id ORDER BY d.j) + 1
           ELSE d.v END AS w
    FROM dp d JOIN rtok ON rtok.model = d.model AND rtok.sample_id = d.sample_id AND rtok.i = d.i + 1
    WHERE d.i < d.n
  )
),
lcs AS (
  SELECT model, sample_id, max(v) AS lcs FROM dp WHERE i = n GROUP BY model, sample_id
),
f AS (
  SELECT t.model, t.sample_id, coalesce(l.lcs, 0) AS lcs, len(t.pt) AS np, len(t.rt) AS nr FROM tok t
  LEFT JOIN lcs l ON l.model = t.model AND l.sample_id = t.sample_id
),
pr AS (
  SELECT model, CASE WHEN np > 0 AND nr > 0 THEN lcs / np ELSE 0 END AS p,
         CASE WHEN np > 0 AND nr > 0 THEN lcs / nr ELSE 0 END AS r FROM f
)
SELECT model, 'rouge_rougeL' AS metric, round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END), 6) AS value
FROM pr GROUP BY model"""
SQL["rouge_l"] = ROUGE_L
ROUGE_L_STEMMED = ROUGE_L.replace(PLAIN_TOK, STEMMED_TOK)

# Summary-level ROUGE-L: the same table for every pair of lines, then the way back through it (to the left where
# the cell there is larger than the one above), the union of its places per reference line, and clipped counts.
SQL["rouge_lsum"] = f"""WITH RECURSIVE {ROWS},
lines AS MATERIALIZED (
  SELECT model, sample_id, side, x, {_rouge_tok("line")} AS t FROM (
    SELECT model, sample_id, side, generate_subscripts(l, 1) AS x, unnest(l) AS line FROM (
      SELECT model, sample_id, 'r' AS side, string_split(coalesce(reference, ''), chr(10)) AS l FROM scored_rows
      UNION ALL SELECT model, sample_id, 'p', string_split(coalesce(prediction, ''), chr(10)) FROM scored_rows))),
pair AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY r.model, r.sample_id, r.x, p.x) AS id, r.model, r.sample_id, r.x, r.t AS rt, p.t AS pt
  FROM lines r JOIN lines p ON p.model = r.model AND p.sample_id = r.sample_id AND p.side = 'p' AND len(p.t) > 0
  WHERE r.side = 'r' AND len(r.t) > 0),
rtok AS (SELECT id, generate_subscripts(rt, 1)::INT AS i, unnest(rt) AS a FROM pair),
dp AS (
  SELECT id, 0 AS i, j, CASE WHEN j > 0 THEN pt[j] END AS b, len(rt) AS n, 0 AS v
  FROM pair, LATERAL (SELECT unnest(range(0, len(pt) + 1)) AS j)
  UNION ALL
  SELECT id, i, j, b, n, max(w) OVER (PARTITION BY id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  FROM (SELECT d.id, d.i + 1 AS i, d.j, d.b, d.n, CASE WHEN d.j = 0 THEN 0
               WHEN rtok.a = d.b THEN lag(d.v) OVER (PARTITION BY d.id ORDER BY d.j) + 1 ELSE d.v END AS w
        FROM dp d JOIN rtok ON rtok.id = d.id AND rtok.i = d.i + 1 WHERE d.i < d.n)),
cell AS MATERIALIZED (
  SELECT dp.id, dp.i, j, CASE WHEN rtok.a = b THEN 'd'
           WHEN lag(v) OVER (PARTITION BY dp.id, dp.i ORDER BY j) > lag(v) OVER (PARTITION BY dp.id, j ORDER BY dp.i) THEN 'l' ELSE 'u' END AS way
  FROM dp LEFT JOIN rtok ON rtok.id = dp.id AND rtok.i = dp.i),
moves AS MATERIALIZED (
  SELECT id, i, string_agg(way, '' ORDER BY j) AS way FROM cell WHERE i > 0 AND j > 0 GROUP BY id, i),
walk AS (  -- a row at a time: left as far as it goes, then up
  SELECT id, len(rt)::BIGINT AS i, len(pt)::BIGINT AS j, NULL::BIGINT AS hit FROM pair
  UNION ALL
  SELECT id, i - 1, CASE WHEN ends_with(way, 'd') THEN length(way) - 1 ELSE length(way) END, CASE WHEN ends_with(way, 'd') THEN i END
  FROM (SELECT w.id, w.i, rtrim(substring(moves.way, 1, w.j), 'l') AS way
        FROM walk w JOIN moves ON moves.id = w.id AND moves.i = w.i WHERE w.i > 0 AND w.j > 0)),
places AS (
  SELECT DISTINCT model, sample_id, x, hit, rt[hit] AS tok FROM walk JOIN pair ON pair.id = walk.id WHERE hit IS NOT NULL),
had AS (SELECT model, sample_id, side, tok, count(*) AS n FROM (SELECT model, sample_id, side, unnest(t) AS tok FROM lines) GROUP BY ALL),
hits AS (
  SELECT h.model, h.sample_id, sum(least(h.n, r.n, p.n)) AS hits
  FROM (SELECT model, sample_id, tok, count(*) AS n FROM places GROUP BY ALL) h
  JOIN had r ON r.model = h.model AND r.sample_id = h.sample_id AND r.tok = h.tok AND r.side = 'r'
  JOIN had p ON p.model = h.model AND p.sample_id = h.sample_id AND p.tok = h.tok AND p.side = 'p' GROUP BY 1, 2),
total AS (
  SELECT model, sample_id, sum(len(t)) FILTER (WHERE side = 'p') AS np, sum(len(t)) FILTER (WHERE side = 'r') AS nr
  FROM lines GROUP BY 1, 2)
SELECT t.model, 'rouge_rougeLsum' AS metric, round(avg(CASE WHEN h.hits > 0 THEN 2.0 * h.hits / (np + nr) ELSE 0.0 END), 6) AS value
FROM total t LEFT JOIN hits h ON h.model = t.model AND h.sample_id = t.sample_id GROUP BY t.model"""

# FX2L predictions are prefixes of their references, so the LCS has a closed form: all
# prediction tokens where they are a prefix of the reference's; otherwise all but the last (cut) one,
# and that too if it occurs in the reference at or after its own place.
SQL["rouge_l_long"] = f"""
WITH t AS (
  SELECT doc_id, {_rouge_tok("substring(text, 1, length(text) // 2)")} AS pt, {_rouge_tok('text')} AS rt FROM documents
),
l AS (
  SELECT doc_id, len(pt) AS np, len(rt) AS nr, CASE WHEN len(pt) = 0 OR len(rt) = 0 THEN 0
    WHEN rt[1:len(pt)] = pt THEN len(pt)
    ELSE len(pt) - 1 + list_contains(rt[len(pt):], pt[len(pt)])::INT END AS lcs FROM t
)
SELECT 'fine_tuned' AS model, doc_id AS sample_id, lcs::BIGINT AS lcs,
  round(CASE WHEN lcs > 0 THEN 2.0 * (lcs / np) * (lcs / nr) / (lcs / np + lcs / nr) ELSE 0.0 END, 6) AS f1 FROM l"""

# the hash encoder: eight bytes of each token's md5, and half of those of the token before
SQL["bertscore_texts"] = f"""WITH {PAIRS},
tok AS (
  SELECT model, sample_id, side, generate_subscripts(w, 1) AS i, unnest(w) AS t FROM (
    SELECT model, sample_id, side, list_filter(regexp_split_to_array(x, '{SPACE}+'), lambda y: y <> '') AS w FROM (
      SELECT model, sample_id, 'pred' AS side, prediction AS x FROM pairs UNION ALL SELECT model, sample_id, 'ref', reference FROM pairs))),
h AS (SELECT t, list_transform(range(8), lambda d: ('0x' || substr(md5(t), 2 * d + 1, 2))::INT / 127.5 - 1) AS v
      FROM (SELECT DISTINCT t FROM tok)),
vec AS (
  SELECT model, sample_id, side, i, CASE WHEN before IS NULL THEN v ELSE list_transform(range(1, 9), lambda d: v[d] + 0.5 * before[d]) END AS v
  FROM (SELECT tok.*, h.v, lag(h.v) OVER (PARTITION BY model, sample_id, side ORDER BY i) AS before FROM tok JOIN h ON h.t = tok.t)),
cos AS (
  SELECT p.model, p.sample_id, p.i AS pi, r.i AS ri, list_cosine_similarity(p.v, r.v) AS c
  FROM vec p JOIN vec r ON r.model = p.model AND r.sample_id = p.sample_id AND r.side = 'ref' WHERE p.side = 'pred'),
bp AS (SELECT model, sample_id, avg(c) AS p FROM (SELECT model, sample_id, pi, max(c) AS c FROM cos GROUP BY ALL) GROUP BY ALL),
br AS (SELECT model, sample_id, avg(c) AS r FROM (SELECT model, sample_id, ri, max(c) AS c FROM cos GROUP BY ALL) GROUP BY ALL),
b AS (
  SELECT s.model, s.sample_id, coalesce(p, 0) AS p, coalesce(r, 0) AS r FROM (SELECT DISTINCT model, sample_id FROM tok) s
  LEFT JOIN bp ON bp.model = s.model AND bp.sample_id = s.sample_id LEFT JOIN br ON br.model = s.model AND br.sample_id = s.sample_id)
SELECT model, sample_id, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1
FROM b"""

# J7 and the report, with every metric on
BERT = """
SELECT model, 'bertscore_' || m AS metric, round(avg(v), 6) AS value
FROM (SELECT CASE WHEN sample_id % 2 = 0 THEN 'fine_tuned' ELSE 'baseline' END AS model,
        unnest(['precision', 'recall', 'f1']) AS m, unnest([p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END]) AS v
      FROM pr) GROUP BY 1, 2"""
BERT = SQL["embedding_match"].split("SELECT sample_id, round(p, 6)")[0] + BERT
ALL_METRICS = " UNION ALL ".join(f"SELECT * FROM ({q})" for q in (ROUGE_N_STEMMED, ROUGE_L_STEMMED, BLEU, CHRF, BERT))
SQL["metrics_long"] = ALL_METRICS

SQL["eval_report"] = f"""WITH {PAIRS},
ml AS (
  {ALL_METRICS}
  UNION ALL SELECT model, 'judge_accuracy', round(avg(length(prediction) % 11), 6) FROM pairs GROUP BY model
  UNION ALL SELECT model, 'judge_relevance', round(avg(length(reference) % 11), 6) FROM pairs GROUP BY model
  UNION ALL SELECT model, 'judge_tone', round(avg(length(prompt) % 11), 6) FROM pairs GROUP BY model
)
SELECT true AS use_fine_tuned, true AS use_baseline, (SELECT count(DISTINCT sample_id) FROM pairs) AS num_eval_samples,
       model, metric, value FROM ml"""
