"""Template programs that the queries and tests render."""

CHATML = """\
{% for message in messages %}
{{ '<|im_start|>' + message['role'] + '\\n' + message['content'] | trim + '<|im_end|>\\n' }}
{%- endfor %}
{% if add_generation_prompt %}
{{ '<|im_start|>assistant\\n' }}
{%- endif %}
"""

# system text inside the first user turn; turns must alternate
INST = """\
{% if messages[0].role == 'system' %}
    {% set system = messages[0].content | trim %}
    {% set rest = messages[1:] %}
{% else %}
    {% set rest = messages %}
{% endif %}
{{ bos_token }}
{%- for m in rest %}
    {%- if (m.role == 'user') != (loop.index0 % 2 == 0) %}
        {{- raise_exception('user and assistant turns must alternate') }}
    {%- elif m.role == 'user' %}
        {{- '[INST] ' }}
        {%- if loop.first and system is defined %}
            {{- '<<SYS>>' ~ system ~ '<</SYS>> ' }}
        {%- endif %}
        {{- m.content | trim ~ ' [/INST]' }}
    {%- else %}
        {{- ' ' ~ m.content ~ eos_token }}
    {%- endif %}
{%- endfor %}
"""

# the format of operators.template's default markers
MARKERS = """\
{% if tools %}
<start_of_turn>developer
<tools>{{ tools | tojson }}</tools><end_of_turn>
{% endif %}
{% for m in messages %}
<start_of_turn>{{ 'model' if m.role == 'assistant' else m.role }}
{{ m.content }}
{%- for call in m.tool_calls %}
{{- '<start_function_call>call:' ~ call.name ~ '{' }}
{%- for k, v in call.arguments | dictsort %}
{{- k ~ ':<escape>' ~ v ~ '<escape>' }}{{ '' if loop.last else ',' }}
{%- endfor %}
{{- '}<end_function_call>' }}
{%- endfor %}
<end_of_turn>
{% endfor %}
{% if add_generation_prompt %}
<start_of_turn>model
{% endif %}
"""
