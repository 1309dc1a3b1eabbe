"""The same results as the catalog's queries in DuckDB SQL, built from the same tables.

The stand-in's answers are rebuilt from md5 and then parsed anew with SQL's own functions.
"""

from __future__ import annotations

from goldleaf import catalog as c
from goldleaf.functions.text import BLANKS
from goldleaf.operators.prompts import TEXT_MARKER
from goldleaf.plans.agents import default_agents
from goldleaf.plans.analysis import BINS
from goldleaf.stub import CASE_COUNT, CASES, FATAL_EVERY, LABELS, PLAIN, TOPICS

# Fixed values, written out here as well so that a wrong one elsewhere shows.
CATEGORIES = [
    "Electronics", "Clothing & Apparel", "Home & Garden", "Books & Media", "Sports & Outdoors", "Food & Beverages",
    "Health & Beauty", "Toys & Games", "Automotive", "E-commerce", "Other",
]
SENTIMENTS = ["positive", "negative", "neutral"]
CONFIDENCE_THRESHOLD = 0.7
# USD per 1,000 tokens: model, input, output.
PRICES = [
    ("gpt-4o", "0.005", "0.015"),
    ("gpt-4o-mini", "0.00015", "0.0006"),
    ("gpt-4-turbo", "0.01", "0.03"),
    ("gpt-3.5-turbo", "0.0005", "0.0015"),
    ("gemini-1.5-pro", "0.007", "0.021"),
    ("gemini-1.5-flash", "0.00035", "0.00105"),
]


def q(text: str) -> str:
    """A SQL text literal; control characters go in by code."""
    parts, plain = [], ""
    for ch in text:
        if ord(ch) < 32:
            parts += [f"'{plain}'", f"chr({ord(ch)})"]
            plain = ""
        else:
            plain += ch.replace("'", "''")
    parts.append(f"'{plain}'")
    return "(" + " || ".join(p for p in parts if p != "''" or len(parts) == 1) + ")"


def names(values: list[str]) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


BLANK = " || ".join(f"chr({ord(ch)})" for ch in BLANKS)


def strip(sql: str) -> str:
    return f"trim({sql}, {BLANK})"


def part(position: int, modulus: int, hashed: str = "h") -> str:
    return f"(('0x' || substr({hashed}, {position}, 4))::BIGINT % {modulus})"


def answer_sql() -> str:
    whens = []
    for agent, cases in CASES.items():
        for number, text in cases.items():
            whens.append(f"WHEN agent = '{agent}' AND {part(1, CASE_COUNT)} = {number} THEN {q(text)}")
        whens.append(f"WHEN agent = '{agent}' THEN {q(PLAIN[agent])}")
    topic = f"{names(TOPICS)}[{part(5, len(TOPICS))} + 1]"
    label = f"{names(LABELS)}[{part(5, len(LABELS))} + 1]"
    number = part(9, 1001)
    confidence = f"CASE WHEN {number} = 1000 THEN '1.0' ELSE '0.' || lpad({number}::VARCHAR, 3, '0') END"
    values = [
        ("%L", label), ("%U", f"upper({label})"), ("%C", confidence), ("%K", topic), ("%k", f"lower({topic})"),
        ("%S", f"'Kind ' || {part(13, 7)}"), ("%B", f"'Brand ' || {part(13, 41)}"),
        ("%D", f"'Brand ' || {part(17, 41)}"), ("%P", f"'Place ' || {part(21, 29)}"),
        ("%N", f"'Person ' || {part(25, 53)}"),
    ]
    sql = "CASE " + " ".join(whens) + " END"
    for marker, value in values:
        sql = f"replace({sql}, '{marker}', {value})"
    return sql


def string_list(name: str) -> str:
    item = """CASE json_type(x)
        WHEN 'VARCHAR' THEN nullif({text}, '')
        WHEN 'BOOLEAN' THEN CASE WHEN x::VARCHAR = 'true' THEN 'True' END
        WHEN 'NULL' THEN NULL
        ELSE CASE WHEN try_cast(x::VARCHAR AS DOUBLE) = 0 THEN NULL ELSE x::VARCHAR END END""".format(
        text=strip("(x->>'$')")
    )
    items = f"list_filter(list_transform(CAST(json_extract(j, '$.{name}') AS JSON[]), lambda x: {item}), lambda x: x IS NOT NULL)"
    return f"CASE WHEN json_type(j, '$.{name}') = 'ARRAY' THEN {items} ELSE [] END"


def distinct_list(sql: str) -> str:
    return f"list_filter({sql}, lambda x, i: list_position({sql}, x) = i)"


def text_field(name: str) -> str:
    return (
        f"CASE WHEN json_type(j, '$.{name}') IS NULL THEN '' WHEN json_type(j, '$.{name}') = 'NULL' THEN 'None' "
        f"ELSE json_extract_string(j, '$.{name}') END"
    )


def prompt_texts() -> dict[str, str]:
    """SQL of the prompt about a document's `text`, by agent."""
    from importlib import resources

    texts = {}
    for a in default_agents():
        text = (resources.files("goldleaf") / "templates" / a.config.prompt_version / f"{a.name}.txt").read_text()
        texts[a.name] = f"replace({q(text)}, '{TEXT_MARKER}', text)"
        for marker, value in a.fills:
            texts[a.name] = f"replace({texts[a.name]}, '{marker}', {q(value)})"
    return texts


def prompt_text() -> str:
    return "CASE agent " + " ".join(f"WHEN '{a}' THEN {sql}" for a, sql in prompt_texts().items()) + " END"


def parsed(agents: list[str], attempts: int, fatal: bool = True, models: dict | None = None) -> str:
    """CTEs up to `parsed`: every answer to the documents of `source_docs`, parsed."""
    models = models or c.MODELS
    model = "CASE agent " + " ".join(f"WHEN '{a}' THEN '{m}'" for a, m in models.items()) + " END"
    lists = ", ".join(f"{distinct_list(f'raw_{n}')} AS {n}" for n in ("brands", "locations", "persons"))
    raw_lists = ", ".join(f"{string_list(n)} AS raw_{n}" for n in ("brands", "locations", "persons"))
    return f"""
    asked AS (
        SELECT CAST(doc_id AS VARCHAR) AS record_id, agent, attempt,
               md5(agent || ':' || doc_id || ':' || attempt || ':' || md5({prompt_text()})) AS h,
               {part(1, FATAL_EVERY, "md5('fatal:' || doc_id)")} = 0 AS fatal
        FROM source_docs, unnest({names(agents)}) AS a(agent), range(1, {attempts + 1}) AS r(attempt)
        WHERE text IS NOT NULL AND trim(text) <> ''),
    answers AS (
        SELECT record_id, agent, attempt, fatal, {model} AS model,
               CASE WHEN NOT fatal THEN {answer_sql()} END AS raw,
               CASE WHEN fatal THEN 0 ELSE {part(29, 300)} + 40 END AS tokens,
               CASE WHEN fatal THEN 0 ELSE {part(21, 900)} / 8.0::DOUBLE END AS latency_ms
        FROM asked),
    cleaned AS (SELECT *, {strip("regexp_replace(raw, '`{3}(json)?', '', 'g')")} AS clean FROM answers),
    checked AS (SELECT *, CASE WHEN json_valid(clean) THEN clean::JSON END AS j0 FROM cleaned),
    objects AS (SELECT *, CASE WHEN json_type(j0) = 'OBJECT' THEN j0 END AS j FROM checked),
    fields AS (
        SELECT *,
            lower({text_field('sentiment')}) AS label,
            CASE WHEN json_type(j, '$.confidence') IS NULL THEN 0.0::DOUBLE
                 WHEN json_type(j, '$.confidence') = 'NULL' THEN NULL
                 WHEN json_type(j, '$.confidence') = 'BOOLEAN'
                     THEN CASE WHEN json_extract_string(j, '$.confidence') = 'true' THEN 1.0 ELSE 0.0 END
                 ELSE try_cast(json_extract_string(j, '$.confidence') AS DOUBLE) END AS conf,
            {strip(text_field('category'))} AS topic,
            {strip(text_field('subcategory'))} AS sub,
            {raw_lists}
        FROM objects),
    good AS (
        SELECT *, {lists},
            coalesce(j IS NOT NULL AND (agent <> 'sentiment' OR (label IN ({", ".join(map(q, SENTIMENTS))}) AND conf BETWEEN 0 AND 1)), FALSE) AS ok,
            coalesce({names(CATEGORIES)}[list_position({names([x.lower() for x in CATEGORIES])}, lower(topic))], 'Other') AS cat
        FROM fields),
    parsed AS (SELECT * FROM good)"""




def price(model: str, position: int) -> str:
    return (
        f"CASE {model} "
        + " ".join(f"WHEN '{row[0]}' THEN {row[position]}::DECIMAL(12,6)" for row in PRICES)
        + " ELSE 0::DECIMAL(12,6) END"
    )


def cost(model: str, tokens_in: str, tokens_out: str) -> str:
    """Money in 1e-8 units is a whole number: tokens times (price * 1e5)."""
    return (
        f"((({tokens_in})::BIGINT * ({price(model, 1)} * 100000)::BIGINT + "
        f"({tokens_out})::BIGINT * ({price(model, 2)} * 100000)::BIGINT))"
    )


MONEY = "/ 1e8::DOUBLE"


def split(tokens: str, share: str) -> str:
    return f"trunc(({tokens})::DOUBLE * {share}::DOUBLE)::INTEGER"


def gold(source: str, three: tuple[str, ...] = ("sentiment", "category", "entity")) -> str:
    """CTEs up to `gold` for the documents that `source` selects."""
    tokens = "CASE WHEN ok THEN tokens ELSE 0 END"
    three = list(three)
    return f"""WITH source_docs AS ({source}),
    {parsed(three, 3)},
    settled AS (
        SELECT *, {tokens} AS paid FROM parsed
        QUALIFY row_number() OVER (PARTITION BY record_id, agent ORDER BY
            NOT ok, CASE WHEN ok OR fatal THEN attempt ELSE -attempt END) = 1),
    run_log AS (
        SELECT record_id, CASE agent WHEN 'sentiment' THEN 'SentimentAgent' WHEN 'category' THEN 'CategoryAgent' ELSE 'EntityAgent' END AS agent,
            model, {split('paid', '0.6')} AS input_tokens, {split('paid', '0.4')} AS output_tokens,
            {split('paid', '0.6')} + {split('paid', '0.4')} AS total_tokens,
            {cost('model', split('paid', '0.6'), split('paid', '0.4'))} AS cost8
        FROM settled WHERE NOT fatal),
    costs AS (SELECT record_id, sum(cost8)::BIGINT AS cost8 FROM run_log GROUP BY record_id),
    per_doc AS (
        SELECT record_id, bool_or(fatal) AS given_up, sum(paid)::INTEGER AS tokens,
            max(CASE WHEN agent = 'sentiment' AND ok THEN label END) AS sentiment,
            max(CASE WHEN agent = 'sentiment' AND ok THEN conf END) AS sentiment_confidence,
            max(CASE WHEN agent = 'category' AND ok THEN cat END) AS category,
            max(CASE WHEN agent = 'category' AND ok THEN sub END) AS subcategory,
            max(CASE WHEN agent = 'entity' AND ok THEN brands END) AS brands,
            max(CASE WHEN agent = 'entity' AND ok THEN locations END) AS locations,
            max(CASE WHEN agent = 'entity' AND ok THEN persons END) AS persons,
            list_sort(list(agent) FILTER (WHERE NOT ok)) AS failed
        FROM settled GROUP BY record_id),
    gold AS (
        SELECT p.record_id AS review_id, d.source AS product_id, d.text AS review_text,
            strftime(DATE '2024-06-01' + (d.doc_id % 30)::INTEGER, '%Y-%m-%d') AS date,
            sentiment, sentiment_confidence, category, subcategory,
            coalesce(brands, []) AS brands, coalesce(locations, []) AS locations, coalesce(persons, []) AS persons,
            '{c.AS_OF}.000000' AS enriched_at,
            CASE WHEN given_up THEN 'unknown' ELSE '{c.MODELS["sentiment"]}' END AS model_used,
            tokens AS tokens_used, coalesce(k.cost8, 0) {MONEY} AS enrichment_cost_usd,
            given_up AS enrichment_error, failed
        FROM per_doc p JOIN source_docs d ON p.record_id = d.doc_id::VARCHAR LEFT JOIN costs k ON k.record_id = p.record_id)
    """


ALL = "SELECT * FROM documents"
WAITING = "SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
GOLD = gold(ALL)
LISTS = ", ".join(f"CAST(to_json({n}) AS VARCHAR) AS entities_{n}" for n in ("brands", "locations", "persons"))
FLAT = f"""product_id, date, sentiment, sentiment_confidence, category, subcategory, {LISTS},
    enriched_at, model_used, tokens_used, enrichment_cost_usd, enrichment_error"""
MENTIONS = """, mentions AS (
    SELECT 'brands' AS type, unnest(brands) AS name FROM gold
    UNION ALL SELECT 'locations', unnest(locations) FROM gold
    UNION ALL SELECT 'persons', unnest(persons) FROM gold)"""
NON_BLANK = "text IS NOT NULL AND trim(text) <> ''"

STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"

CALLS = f"""WITH split AS (
    SELECT event_id, ts, event_type AS agent,
        CASE user_id % {len(c.LOG_MODELS)} {" ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(c.LOG_MODELS))} END AS model,
        {split('event_id % 500', '0.6')} AS input_tokens, {split('event_id % 500', '0.4')} AS output_tokens
    FROM events),
    calls AS (
        SELECT ts, agent, model, event_id::VARCHAR AS record_id, input_tokens, output_tokens,
            input_tokens + output_tokens AS total_tokens, {cost('model', 'input_tokens', 'output_tokens')} AS cost8,
            strftime(ts, '%Y-%m-%d') AS batch_id FROM split)
    """
SUMS = f"""count(*) AS calls, sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens,
    sum(total_tokens)::BIGINT AS total_tokens, sum(cost8)::BIGINT {MONEY} AS cost_usd"""
KEYED = f"count(*) AS calls, sum(total_tokens)::BIGINT AS total_tokens, sum(cost8)::BIGINT {MONEY} AS cost_usd"


def rollup(source: str) -> str:
    return f"""SELECT CASE WHEN grouping(agent) = 0 THEN 'agent' WHEN grouping(model) = 0 THEN 'model' ELSE 'total' END AS scope,
        CASE WHEN grouping(agent) = 0 THEN agent WHEN grouping(model) = 0 THEN model END AS name, {SUMS}
        FROM {source} GROUP BY GROUPING SETS ((agent), (model), ())"""


def prompts() -> str:
    return " UNION ALL ".join(
        f"SELECT doc_id::VARCHAR AS record_id, '{a}' AS agent, '{c.MODELS[a]}' AS model, {text} AS prompt FROM documents"
        for a, text in prompt_texts().items()
    )


def one_agent(agent: str, columns: str) -> str:
    return f"WITH source_docs AS ({ALL}), {parsed([agent], 1)} SELECT record_id, raw, ok, {columns} FROM parsed"




def edge(i: str) -> str:
    return f"(({i}) * step + lo)"


ORACLE: dict[str, str] = {
    "pending_fetch": f"SELECT d.* FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL AND {NON_BLANK} ORDER BY d.doc_id",
    "pending_without_gold": f"SELECT doc_id, n_chars FROM documents WHERE {NON_BLANK} ORDER BY doc_id",
    "pending_topk": f"SELECT d.* FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL AND {NON_BLANK} ORDER BY d.doc_id LIMIT 25",
    "pending_count": "SELECT count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL",
    "pending_turns": f"SELECT conv_id || '-' || turn AS turn_id, role, text FROM conversations WHERE role <> 'user' AND {NON_BLANK} ORDER BY 1",
    "fetch_by_ids": "SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) ORDER BY doc_id",
    "prompt_render": prompts(),
    "model_call": f"""WITH p AS ({prompts()}), h AS (SELECT *, md5(agent || ':' || record_id || ':1') AS h FROM p)
        SELECT record_id, agent, 1 AS attempt, model,
            '{{"seen": "' || substr(h, 1, 8) || '", "length": ' || length(prompt) || '}}' AS raw,
            ({part(29, 300)} + 40)::INTEGER AS tokens FROM h""",
    "sentiment_parse": one_agent("sentiment", "CASE WHEN ok THEN label END AS sentiment, CASE WHEN ok THEN conf END AS confidence"),
    "category_parse": one_agent("category", "CASE WHEN ok THEN cat END AS category, CASE WHEN ok THEN sub END AS subcategory"),
    "entity_parse": one_agent(
        "entity",
        ", ".join(f"CASE WHEN ok THEN CAST(to_json({n}) AS VARCHAR) END AS {n}" for n in ("brands", "locations", "persons"))
        + ", CASE WHEN ok THEN (len(brands) + len(locations) + len(persons))::INTEGER END AS total_entities"
        + ", CASE WHEN ok THEN len(brands) + len(locations) + len(persons) = 0 END AS is_empty",
    ),
    "first_valid_attempt": f"""WITH source_docs AS ({ALL}), {parsed(["sentiment", "category", "entity"], 3)}
        SELECT record_id, agent, attempt::INTEGER AS attempt, ok, tokens::INTEGER AS tokens, raw FROM parsed
        QUALIFY row_number() OVER (PARTITION BY record_id, agent ORDER BY NOT ok, CASE WHEN ok THEN attempt ELSE -attempt END) = 1""",
    "enrich_wide": f"""{gold(WAITING)} SELECT review_id::BIGINT AS doc_id, review_text AS text, {FLAT},
        CAST(to_json(CASE WHEN len(failed) > 0 THEN failed END) AS VARCHAR) AS failed_agents FROM gold""",
    "gold_table": f"{GOLD} SELECT review_id, review_text, {FLAT} FROM gold",
    "null_enrichment": f"{GOLD} SELECT review_id, review_text, {FLAT} FROM gold WHERE enrichment_error",
    "run_calls": f"""{GOLD} SELECT record_id, agent, model, input_tokens, output_tokens, total_tokens,
        cost8 {MONEY} AS cost_usd, '{c.AS_OF}.000000' AS timestamp FROM run_log""",
    "run_summary": f"""{gold(WAITING)} SELECT (SELECT count(*) FROM gold) AS records_processed, 1::BIGINT AS batches_processed,
        (SELECT sum(cost8)::BIGINT {MONEY} FROM run_log) AS total_cost_usd, (SELECT sum(total_tokens)::BIGINT FROM run_log) AS total_tokens,
        agent, count(*) AS calls, sum(total_tokens)::BIGINT AS tokens, sum(cost8)::BIGINT {MONEY} AS cost_usd FROM run_log GROUP BY agent""",
    "call_metrics": f"""{GOLD}, ordered AS (
            SELECT *, coalesce(bool_or(ok OR fatal) OVER (PARTITION BY record_id, agent ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS over
            FROM parsed)
        SELECT agent, model, attempt::INTEGER AS attempt, count(*) AS calls, count(*) FILTER (WHERE ok) AS accepted,
            count(*) FILTER (WHERE fatal) AS errors, sum(tokens)::BIGINT AS tokens, round(avg(latency_ms), 6) AS avg_latency_ms FROM ordered WHERE NOT over GROUP BY agent, model, attempt""",
    "gold_upsert": """WITH docs AS (SELECT doc_id::VARCHAR AS review_id, source AS product_id, text AS review_text,
            strftime(DATE '2024-06-01' + (doc_id % 30)::INTEGER, '%Y-%m-%d') AS date, l.quality
            FROM documents LEFT JOIN labels l USING (doc_id))
        SELECT review_id, product_id, review_text, date,
            CASE WHEN quality = 0 THEN '2024-06-01 00:00:00.000000' ELSE '2024-06-03 00:00:00.000000' END AS enriched_at,
            CASE WHEN quality = 0 THEN 'old' ELSE 'late' END AS model_used, '[]' AS entities_brands FROM docs""",
    "batch_assign": f"""SELECT d.doc_id, ((row_number() OVER (ORDER BY d.doc_id) - 1) // {c.BATCH_SIZE})::BIGINT AS batch
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL AND {NON_BLANK}""",
    "call_log": f"""{CALLS} SELECT {STAMP.format('ts')} AS timestamp, agent, model, record_id, input_tokens, output_tokens,
        total_tokens, cost8 {MONEY} AS cost_usd, batch_id FROM calls""",
    "cost_rollup": f"{CALLS} {rollup('calls')}",
    "cost_totals": f"{CALLS} SELECT {SUMS} FROM calls",
    "cost_by_agent": f"{CALLS} SELECT agent, {KEYED} FROM calls GROUP BY agent",
    "cost_by_model": f"{CALLS} SELECT model, {KEYED} FROM calls GROUP BY model",
    "run_cost_summary": f"{CALLS} {rollup('(SELECT * FROM calls WHERE batch_id = (SELECT max(batch_id) FROM calls))')}",
    "unpriced_models": f"{CALLS} SELECT model, count(*) AS calls FROM calls WHERE model NOT IN ({', '.join(q(p[0]) for p in PRICES)}) GROUP BY model",
    "agent_breakdown": f"""{CALLS} SELECT agent, count(*) AS calls, sum(total_tokens)::BIGINT AS total_tokens,
        round((sum(cost8)::DECIMAL(28,0) / 100000000)::DECIMAL(28,8), 4)::DOUBLE AS total_cost, round(avg(total_tokens), 4) AS avg_tokens FROM calls GROUP BY agent""",
    "cumulative_cost": f"""{CALLS} SELECT {STAMP.format('ts')} AS timestamp, record_id, agent, cost8 {MONEY} AS cost_usd,
        (sum(cost8) OVER (ORDER BY ts, record_id, agent ROWS UNBOUNDED PRECEDING))::BIGINT {MONEY} AS cumulative_cost FROM calls""",
    "budget_crossing": f"""{CALLS}, spent AS (SELECT *, (sum(cost8) OVER (PARTITION BY batch_id ORDER BY ts, record_id, agent ROWS UNBOUNDED PRECEDING))::BIGINT AS s FROM calls),
        beyond AS (SELECT *, count(*) OVER (PARTITION BY batch_id) AS calls_over FROM spent WHERE s > {int(c.BUDGET_USD * 10**8)})
        SELECT batch_id, {STAMP.format('ts')} AS timestamp, record_id, agent, s {MONEY} AS cumulative_cost, calls_over FROM beyond
        QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY ts, record_id, agent) = 1""",
    "usage_window": f"""{CALLS}, w AS (SELECT *, count(*) OVER win AS n, sum(total_tokens) OVER win AS t FROM calls
            WINDOW win AS (PARTITION BY agent ORDER BY ts RANGE BETWEEN INTERVAL {c.WINDOW} SECONDS PRECEDING AND CURRENT ROW))
        SELECT agent, {STAMP.format('ts')} AS timestamp, record_id, total_tokens, n AS requests_in_window, t::BIGINT AS tokens_in_window,
            n - 1 < {c.RPM} AS rpm_ok, t <= {c.TPM} AS tpm_ok FROM w""",
    "current_usage": f"""{CALLS}, now AS (SELECT max(ts) AS now FROM calls)
        SELECT agent, count(*) FILTER (WHERE ts >= now - INTERVAL {c.WINDOW} SECONDS) AS current_rpm,
            coalesce(sum(total_tokens) FILTER (WHERE ts >= now - INTERVAL {c.WINDOW} SECONDS), 0)::BIGINT AS current_tpm
        FROM calls, now GROUP BY agent""",
    "token_boxplot": f"""{CALLS}, box AS (SELECT agent, quantile_cont(total_tokens, 0.25) AS q1, quantile_cont(total_tokens, 0.5) AS median,
            quantile_cont(total_tokens, 0.75) AS q3 FROM calls GROUP BY agent),
        marked AS (SELECT *, total_tokens BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside FROM calls JOIN box USING (agent))
        SELECT agent, count(*) AS n, least(min(total_tokens) FILTER (WHERE inside), min(q1))::DOUBLE AS whisker_lo, min(q1) AS q1, min(median) AS median, min(q3) AS q3,
            greatest(max(total_tokens) FILTER (WHERE inside), max(q3))::DOUBLE AS whisker_hi, count(*) FILTER (WHERE NOT inside) AS outliers FROM marked GROUP BY agent""",
    "gold_overview": f"""{GOLD} SELECT count(*) AS records, min(date) AS first_date, max(date) AS last_date,
        sum(enrichment_error::INTEGER)::BIGINT AS errors, round(avg(enrichment_error::INTEGER), 6) AS error_rate FROM gold""",
    "null_rates": f"{GOLD} " + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, round(avg(({col} IS NULL)::INTEGER), 6) AS null_rate FROM gold"
        for name, col in [
            ("sentiment", "sentiment"), ("sentiment_confidence", "sentiment_confidence"), ("category", "category"),
            ("subcategory", "subcategory"), ("entities_brands", "brands"), ("entities_locations", "locations"),
            ("entities_persons", "persons"),
        ]
    ),
    "sentiment_counts": f"{GOLD} SELECT sentiment, count(*) AS n FROM gold WHERE sentiment IS NOT NULL GROUP BY sentiment",
    "sentiment_share": f"{GOLD} SELECT sentiment, round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 4) AS share FROM gold WHERE sentiment IS NOT NULL GROUP BY sentiment",
    "top_categories": f"{GOLD} SELECT category, count(*) AS n FROM gold WHERE category IS NOT NULL GROUP BY category ORDER BY n DESC, category LIMIT 15",
    "category_sentiment_pct": f"""{GOLD}, best AS (SELECT category FROM gold WHERE category IS NOT NULL GROUP BY category ORDER BY count(*) DESC, category LIMIT 8)
        SELECT category, {", ".join(f"count(*) FILTER (WHERE sentiment = '{s}') AS {s}" for s in SENTIMENTS)},
            {", ".join(f"round(count(*) FILTER (WHERE sentiment = '{s}') / count(*)::DOUBLE * 100, 6) AS {s}_pct" for s in SENTIMENTS)}
        FROM gold WHERE sentiment IS NOT NULL AND category IN (SELECT category FROM best) GROUP BY category""",
    "top_subcategories": f"""{GOLD}, best AS (SELECT category FROM gold WHERE category IS NOT NULL GROUP BY category ORDER BY count(*) DESC, category LIMIT 1)
        SELECT subcategory, count(*) AS n FROM gold WHERE category IN (SELECT category FROM best) AND subcategory IS NOT NULL
        GROUP BY subcategory ORDER BY n DESC, subcategory LIMIT 10""",
    "median_confidence": f"{GOLD} SELECT sentiment, round(median(sentiment_confidence), 3) AS median_confidence FROM gold WHERE sentiment IS NOT NULL AND sentiment_confidence IS NOT NULL GROUP BY sentiment",
    "confidence_histogram": f"""{GOLD}, scored AS (SELECT sentiment, sentiment_confidence AS v FROM gold WHERE sentiment IS NOT NULL AND sentiment_confidence IS NOT NULL),
        spans AS (SELECT sentiment, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo, CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM scored GROUP BY sentiment),
        steps AS (SELECT *, (hi - lo) / {BINS} AS step FROM spans),
        bins AS (SELECT *, b::INTEGER AS bin FROM steps, range(0, {BINS}) AS r(b))
        SELECT sentiment, bin, round({edge('bin')}, 6) AS bin_lo, round(CASE WHEN bin = {BINS - 1} THEN hi ELSE {edge('bin + 1')} END, 6) AS bin_hi,
            (SELECT count(*) FROM scored s WHERE s.sentiment = bins.sentiment AND s.v >= {edge('bin')} AND (bin = {BINS - 1} OR s.v < {edge('bin + 1')})) AS n
        FROM bins""",
    "mean_confidence": f"{GOLD} SELECT round(avg(sentiment_confidence), 6) AS avg_sentiment_confidence FROM gold",
    "entity_distinct": f"{GOLD}{MENTIONS} SELECT type, count(DISTINCT name) AS unique_names FROM mentions GROUP BY type",
    "top_entities": f"""{GOLD}{MENTIONS}, n AS (SELECT type, name, count(*) AS n FROM mentions GROUP BY type, name)
        SELECT type, name, n, (row_number() OVER (PARTITION BY type ORDER BY n DESC, name))::INTEGER AS place FROM n
        QUALIFY row_number() OVER (PARTITION BY type ORDER BY n DESC, name) <= 10""",
    "entity_mentions_json": f"{GOLD} SELECT review_id, unnest(brands) AS brand FROM gold",
    "low_confidence": f"{GOLD} SELECT review_id, sentiment, sentiment_confidence FROM gold WHERE sentiment_confidence < {CONFIDENCE_THRESHOLD}::DOUBLE",
    "low_confidence_share": f"""{GOLD} SELECT count(*) FILTER (WHERE sentiment_confidence < {CONFIDENCE_THRESHOLD}::DOUBLE) AS low,
        round(count(*) FILTER (WHERE sentiment_confidence < {CONFIDENCE_THRESHOLD}::DOUBLE) / count(*)::DOUBLE * 100, 6) AS low_pct FROM gold""",
    "worst_confidence": f"""{GOLD} SELECT review_id, review_text, sentiment, sentiment_confidence FROM gold
        WHERE sentiment_confidence < {CONFIDENCE_THRESHOLD}::DOUBLE ORDER BY sentiment_confidence, review_id LIMIT 10""",
    "error_rows": f"{GOLD} SELECT review_id, review_text FROM gold WHERE enrichment_error",
    "error_sample": f"{GOLD} SELECT review_id, review_text FROM gold WHERE enrichment_error ORDER BY review_id LIMIT 5",
    "gold_head": f"{GOLD} SELECT review_id, review_text, {FLAT} FROM gold ORDER BY review_id LIMIT 3",
    "summary_report": f"""{GOLD}{MENTIONS},
        shares AS (SELECT sentiment, round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 4) AS share FROM gold WHERE sentiment IS NOT NULL GROUP BY sentiment),
        cats AS (SELECT category, count(*) AS n FROM gold WHERE category IS NOT NULL GROUP BY category ORDER BY n DESC, category LIMIT 5)
        SELECT count(*) AS total_records, round(avg(enrichment_error::INTEGER), 6) AS enrichment_error_rate,
            round(avg(sentiment_confidence), 6) AS avg_sentiment_confidence,
            (SELECT '{{' || string_agg('"' || sentiment || '":' || share, ',' ORDER BY sentiment) || '}}' FROM shares) AS sentiment_distribution,
            (SELECT '{{' || string_agg('"' || category || '":' || n, ',' ORDER BY category) || '}}' FROM cats) AS top_categories,
            (SELECT count(DISTINCT name) FROM mentions WHERE type = 'brands') AS unique_brands,
            (SELECT count(DISTINCT name) FROM mentions WHERE type = 'locations') AS unique_locations FROM gold""",
    "stream_enrich": f"{GOLD} SELECT review_id, review_text, {FLAT} FROM gold",
    "stream_usage": f"""{CALLS}, late AS (SELECT (epoch_us(max(ts)) // 1000 - 120000) * 1000 AS mark FROM calls),
        windows AS (SELECT agent, total_tokens, unnest(range((epoch_us(ts) - 60000000) // 10000000 + 1, epoch_us(ts) // 10000000 + 1)) * 10000000 AS start_us FROM calls)
        SELECT {STAMP.format("make_timestamp(start_us)")} AS window_start, agent, count(*) AS requests, sum(total_tokens)::BIGINT AS tokens
        FROM windows, late WHERE start_us + 60000000 <= mark GROUP BY start_us, agent""",
}

ORACLE |= {
    "pending_dirty": """SELECT doc_id, n_chars FROM documents WHERE trim(CASE doc_id % 5 WHEN 0 THEN NULL
        WHEN 1 THEN '' WHEN 2 THEN '   ' WHEN 3 THEN ' ' || chr(9) || chr(10) || ' ' ELSE text END) <> ''""",
    "prompt_dirty": "SELECT doc_id::VARCHAR AS record_id, agent, doc_id % 5 < 2 AS no_prompt FROM documents, unnest(['sentiment', 'category', 'entity']) a(agent)",
    "json_records": """SELECT doc_id::VARCHAR AS review_id, source AS product_id, text AS review_text,
        strftime(DATE '2024-06-01' + (doc_id % 30)::INTEGER, '%Y-%m-%d') AS date FROM documents""",
    "upsert_agent_rows": """SELECT doc_id::VARCHAR AS review_id,
        (CASE WHEN doc_id % 3 <> 0 THEN doc_id % 7 ELSE 0 END + CASE WHEN doc_id % 4 <> 0 THEN doc_id % 5 ELSE 0 END)::INTEGER AS tokens_used,
        CASE WHEN doc_id % 2 = 0 THEN 'm-sentiment' WHEN doc_id % 3 = 1 THEN 'given' WHEN doc_id % 5 = 0 THEN 'm-category' ELSE 'unknown' END AS model_used
        FROM documents""",
    "upsert_single": """SELECT review_id, CASE WHEN nth = 1 THEN 'positive' ELSE 'neutral' END AS sentiment,
        (CASE WHEN nth = 1 THEN 7 ELSE 0 END)::INTEGER AS tokens_used, CASE WHEN nth = 1 THEN 'm' ELSE 'unknown' END AS model_used
        FROM (SELECT doc_id::VARCHAR AS review_id, row_number() OVER (ORDER BY doc_id::VARCHAR) AS nth FROM documents)""",
    "gold_count": f"SELECT count(*) AS n_read, count(*) AS n_listed FROM documents WHERE {NON_BLANK}",
    "log_missing": ORACLE["cost_totals"],
    "report_sink": ORACLE["summary_report"],
}

# What a stream has passed once it has read all events: two minutes before the last, to the millisecond.
PASSED = "(SELECT (epoch_us(max(ts)) // 1000 - 120000) * 1000 FROM calls)"
MINUTES = f"""{CALLS}, minutes AS (
        SELECT batch_id, epoch_us(ts) // 60000000 * 60000000 AS minute, sum(cost8)::BIGINT AS spent FROM calls GROUP BY ALL),
    running AS (
        SELECT *, (sum(spent) OVER (PARTITION BY batch_id ORDER BY minute ROWS UNBOUNDED PRECEDING))::BIGINT AS total
        FROM minutes WHERE minute + 60000000 <= {PASSED})"""
BUDGET8 = int(c.BUDGET_USD * 10**8)

ORACLE |= {
    "stream_limits": f"{ORACLE['usage_window']} WHERE epoch_us(ts) < {PASSED}",
    "stream_running_cost": f"""{MINUTES} SELECT batch_id, {STAMP.format('make_timestamp(minute)')} AS minute, spent {MONEY} AS spent,
        total {MONEY} AS total, total > {BUDGET8} AND total - spent <= {BUDGET8} AS crossed FROM running""",
    "stream_budget": f"""{MINUTES}, spent AS (SELECT *, (sum(cost8) OVER (PARTITION BY batch_id ORDER BY ts, record_id, agent ROWS UNBOUNDED PRECEDING))::BIGINT AS s FROM calls)
        SELECT batch_id, {STAMP.format('ts')} AS timestamp, record_id, agent, s {MONEY} AS cumulative_cost FROM spent
        WHERE s > {BUDGET8} AND epoch_us(ts) // 60000000 * 60000000 + 60000000 <= {PASSED}
        QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY ts, record_id, agent) = 1""",
    "stream_retry": ORACLE["stream_enrich"],
    "pending_filtered": ORACLE["pending_fetch"],
    "pending_filter_share": f"SELECT count(*) AS keys, TRUE AS none_lost, TRUE AS few_joined FROM documents WHERE {NON_BLANK}",
    "pending_bucketed": ORACLE["pending_fetch"],
}

ORACLE |= {
    "cost_rollup_kept": f"{GOLD} {rollup('run_log')}",
    "confidence_sketch": f"""{GOLD} SELECT sentiment, count(*) AS n, TRUE AS within FROM gold
        WHERE sentiment IS NOT NULL AND sentiment_confidence IS NOT NULL GROUP BY sentiment""",
    "entity_distinct_sketch": f"{GOLD}{MENTIONS} SELECT type, count(DISTINCT name) AS unique_names, TRUE AS within FROM mentions GROUP BY type",
    "agents_switched_off": f"""{gold(ALL, ("sentiment", "entity"))} SELECT review_id, sentiment, category, subcategory,
        CAST(to_json(brands) AS VARCHAR) AS entities_brands, tokens_used, model_used FROM gold""",
    "agent_settings": " UNION ALL ".join(
        f"""SELECT doc_id::VARCHAR AS record_id, '{a}' AS agent, '{m}' AS model, {n / 10}::DOUBLE AS temperature,
        {100 * (n + 1)} AS max_tokens, {5 + n} AS timeout_seconds, '{n}' AS seed FROM documents"""
        for n, (a, m) in enumerate(c.MODELS.items())
    ),
    "run_ids": f"SELECT 2 AS ids, TRUE AS well_formed, count(*) AS records FROM documents WHERE {NON_BLANK}",
}

# Other ways to the same rows.
ORACLE |= {"call_metrics_observed": ORACLE["call_metrics"], "top_entities_sketch": ORACLE["top_entities"]}
