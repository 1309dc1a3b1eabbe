"""A stand-in for a model, for tests and benchmarks only.

Answers and latency follow from md5(agent:id:attempt:md5(prompt)), so SQL can rebuild them, and a wrong prompt
shows in every answer. They mix good answers
with the ways a model goes wrong. Timings with this stub say nothing of model latency.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from goldleaf.operators.respond import NO_TEXT, Responder

# Answer templates per agent and case number; other cases give the "plain" one.
# %L label, %C confidence, %K category, %k its lower case, %S subcategory,
# %B brand, %D second brand, %P place, %N person.
CASES = {
    "sentiment": {
        0: "The tone of this text is hard to tell.",
        1: '{"sentiment": "mixed", "confidence": %C}',
        2: '```json\n{"sentiment": "%L", "confidence": %C}\n```',
        3: '{"sentiment": "%U", "confidence": %C}',
        4: '{"sentiment": "%L", "confidence": 1.5}',
        5: '{"sentiment": "%L", "confidence": %C} as asked',
        6: '{"sentiment": "%L", "confidence": "%C"}',
        7: '{"sentiment": "%L"}',
        8: '{"sentiment": "%L", "confidence": null}',
        9: "{'sentiment': '%L', 'confidence': %C}",
        10: '{"sentiment": "%L", "confidence": true}',
        11: '{"sentiment": " %L", "confidence": %C}',
        12: '\n {"note": "x", "sentiment": "%L", "confidence": %C}\n ',
    },
    "category": {
        0: "I would say %K.",
        1: '{"category": "Garden Gnomes", "subcategory": "%S"}',
        2: '{"category": "%k", "subcategory": "%S"}',
        3: '```\n{"category": "%K", "subcategory": "%S"}\n```',
        4: '{"category": "  %K ", "subcategory": " %S "}',
        5: '{"category": null, "subcategory": "%S"}',
        6: '{"category": "%K"}',
        7: '{"category": "%K", "subcategory": null}',
        8: '["%K", "%S"]',
        9: '{"category": 7, "subcategory": "%S"}',
        10: '{"subcategory": "%S"}',
    },
    "entity": {
        0: "No names found",
        1: '{"brands": "%B", "locations": ["%P"], "persons": []}',
        2: '{"brands": ["%B", "%B", "%D"], "locations": ["%P"], "persons": ["%N"]}',
        3: '```json\n{"brands": ["%B"], "locations": ["%P"], "persons": ["%N"]}\n```',
        4: '{"brands": ["%B", null, "", 0, false], "locations": [], "persons": ["%N"]}',
        5: '{"brands": ["%D"], "locations": ["%P"]}',
        6: '{"brands": [], "locations": [], "persons": []}',
        7: '{"brands": [" %B ", "  "], "locations": ["%P", "%P"], "persons": ["%N"]}',
        8: '"%B"',
    },
}
PLAIN = {
    "sentiment": '{"sentiment": "%L", "confidence": %C}',
    "category": '{"category": "%K", "subcategory": "%S"}',
    "entity": '{"brands": ["%B", "%D"], "locations": ["%P"], "persons": ["%N"]}',
}
CASE_COUNT = 20
# A third of all answers fall on one label, category or name.
LABELS = ["positive", "positive", "positive", "positive", "negative", "negative", "neutral"]
TOPICS = [
    "Electronics", "Electronics", "Electronics", "Electronics", "Electronics",
    "Clothing & Apparel", "Home & Garden", "Books & Media", "Sports & Outdoors",
    "Food & Beverages", "Health & Beauty", "Toys & Games", "Automotive", "E-commerce", "Other",
]
FATAL_EVERY = 97


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _part(position: int, modulus: int, hashed: str = "h") -> str:
    """Four hex digits from `position` (from 1), modulo."""
    return f"(cast(conv(substring({hashed}, {position}, 4), 16, 10) as int) % {modulus})"


def _pick(values: list[str], position: int) -> str:
    listed = ", ".join(_text(v) for v in values)
    return f"element_at(array({listed}), {_part(position, len(values))} + 1)"


def _template() -> str:
    """The answer's template, looked up by agent and case number."""
    tables = []
    for agent, cases in CASES.items():
        rows = ", ".join(_text(cases.get(n, PLAIN[agent])) for n in range(CASE_COUNT))
        tables.append(f"WHEN agent = '{agent}' THEN element_at(array({rows}), {_part(1, CASE_COUNT)} + 1)")
    return "CASE " + " ".join(tables) + " END"


def _values() -> dict[str, str]:
    share = _part(9, 1001)
    topic = _pick(TOPICS, 5)
    return {
        "%L": _pick(LABELS, 5),
        "%U": f"upper({_pick(LABELS, 5)})",
        "%C": f"if({share} = 1000, '1.0', concat('0.', lpad({share}, 3, '0')))",
        "%K": topic,
        "%k": f"lower({topic})",
        "%S": f"concat('Kind ', {_part(13, 7)})",
        "%B": f"concat('Brand ', {_part(13, 41)})",
        "%D": f"concat('Brand ', {_part(17, 41)})",
        "%P": f"concat('Place ', {_part(21, 29)})",
        "%N": f"concat('Person ', {_part(25, 53)})",
    }


def _answer() -> str:
    text = _template()
    for marker, value in _values().items():
        text = f"replace({text}, '{marker}', {value})"
    return text


def stub_responder(called_at: str = "2024-06-02 06:00:00") -> Responder:
    """Column-only responder: deterministic, so evaluating it twice does no harm."""
    fatal = _part(1, FATAL_EVERY, "md5(concat('fatal:', record_id))") + " = 0"
    # The lambda gives the hash a name, so that it is worked out once per row.
    said = (
        "transform(array(md5(concat_ws(':', agent, record_id, attempt, md5(prompt)))), h -> "
        f"named_struct('raw', {_answer()}, 'tokens', {_part(29, 300)} + 40, 'latency', {_part(21, 900)} / 8D))[0]"
    )

    def respond(prompts: DataFrame) -> DataFrame:
        return prompts.selectExpr(
            "record_id", "agent", "attempt", "model", "prompt IS NOT NULL AS _asked",
            f"prompt IS NOT NULL AND coalesce({fatal}, false) AS fatal",
            f"CASE WHEN prompt IS NOT NULL AND NOT coalesce({fatal}, false) THEN {said} END AS _said",
        ).selectExpr(
            "record_id", "agent", "attempt", "model",
            "_said.raw AS raw",
            "coalesce(_said.tokens, 0) AS tokens",
            "coalesce(_said.latency, 0D) AS latency_ms",
            f"CASE WHEN NOT _asked THEN {_text(NO_TEXT)} WHEN fatal THEN 'record given up' END AS error",
            "fatal",
            f"TIMESTAMP '{called_at}' AS called_at",
        )

    return respond


def stub_client():
    """Client factory for `pandas_responder`: a fixed answer per agent, tokens by hash."""
    import hashlib

    def call(row) -> tuple[str, int]:
        hashed = hashlib.md5(f"{row.agent}:{row.record_id}:{row.attempt}".encode()).hexdigest()
        length = len(row.prompt)
        return f'{{"seen": "{hashed[:8]}", "length": {length}}}', int(hashed[28:32], 16) % 300 + 40

    return call
