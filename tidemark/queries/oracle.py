"""The expected rows, in SQL straight from the tables: no JSON is read here.

SQL text for the wide rows is put together from the field names, so that the
same 136 columns are not typed out again.
"""

from __future__ import annotations

from tidemark.operators.generate import (
    ATTESTATION_STATUS,
    BUSINESS_CRITICALITY,
    FIRST_KEY_SLOT,
    OPERATIONS,
    RECORD_TYPE,
    SLOTS,
    SOURCE_TABLES,
)
from tidemark.schema import ENVELOPE_FIELDS, KEY_COUNT, NAMED_PAYLOAD_FIELDS, key_names

KIND = "substr(md5(concat(event_id, '#kind')), 1, 1)"
MILLIS = "epoch_us(ts) // 1000"


def _digits(slot: int, first: int, length: int) -> str:
    return f"substr(d[{slot // 2 + 1}], {32 * (slot % 2) + first}, {length})"


def _text(slot: int, mixed: bool = False) -> str:
    if mixed:
        number = f"('0x' || {_digits(slot, 5, 4)})::INT"
        letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
        spare = " || ".join(f"substr('{letters}', {n} % 62 + 1, 1)" for n in (number, f"{number} // 62"))
        return f"translate(to_base64(unhex({_digits(slot, 9, 24)})), '+/', {spare})"
    return _digits(slot, 9, 16)


def _pick(slot: int, pool: tuple[str, ...]) -> str:
    items = ", ".join(f"'{item}'" for item in pool)
    return f"([{items}])[('0x' || {_digits(slot, 5, 4)})::INT % {len(pool)} + 1]"


def _or_null(slot: int, value: str) -> str:
    # NULL in 30 of 100 draws: the first four digits as a number below 30 percent of 16^4.
    return f"CASE WHEN ('0x' || {_digits(slot, 1, 4)})::INT >= 65536 * 30 // 100 THEN {value} END"


def drawn(source: str, row_id: str, count: int = KEY_COUNT, seed: int = 0) -> str:
    """A table with its row digests as list ``d``."""
    blocks = (FIRST_KEY_SLOT + count + 1) // 2
    return (
        f"(SELECT *, list_transform(range({blocks}), lambda b: "
        f"sha256(concat('{seed}#', {row_id}, '#', b))) AS d FROM {source})"
    )


def record(
    timestamp: str, payload: dict[str, str], count: int = KEY_COUNT, mixed: bool = False
) -> dict[str, str]:
    """Field name to SQL expression over a ``drawn`` table."""
    fields = {
        "type": f"'{RECORD_TYPE}'",
        "operation": _pick(SLOTS["operation"], OPERATIONS),
        "source_table": _pick(SLOTS["source_table"], SOURCE_TABLES),
        "payload_sys_id": _text(SLOTS["payload_sys_id"], mixed),
        "timestamp": timestamp,
        "aliases": "NULL::VARCHAR",
    }
    for name in ("asset", "asset_tag", "assigned_to"):
        fields[name] = _or_null(SLOTS[name], _text(SLOTS[name], mixed))
    pools = {
        "attestation_status": ATTESTATION_STATUS,
        "business_criticality": BUSINESS_CRITICALITY,
    }
    for name, pool in pools.items():
        fields[name] = _or_null(SLOTS[name], _pick(SLOTS[name], pool))
    fields.update(payload)
    for i, name in enumerate(key_names(count=count)):
        fields[name] = _or_null(FIRST_KEY_SLOT + i, _text(FIRST_KEY_SLOT + i, mixed))
    return fields


def event_record(count: int = KEY_COUNT) -> dict[str, str]:
    return record(
        MILLIS, {"asset": "event_type", "assigned_to": "CAST(user_id AS VARCHAR)"}, count
    )


def damaged_record() -> dict[str, str]:
    """What is left of each field after the damage done to its message."""
    fields = event_record()
    lost_payload = f"{KIND} IN ('3', '4')"
    for name in fields:
        if name == "timestamp":
            fields[name] = f"CASE WHEN {KIND} NOT IN ('2', '9') THEN {fields[name]} END"
        elif name not in ENVELOPE_FIELDS:
            fields[name] = f"CASE WHEN NOT {lost_payload} THEN {fields[name]} END"
    return fields


DAMAGED_ROWS = f"{KIND} NOT IN ('0', '1', '5', '7')"


def select(fields: dict[str, str], source: str, names=None, where: str | None = None) -> str:
    chosen = list(names or fields)
    columns = ", ".join(f'{fields.get(name, name)} AS "{name}"' for name in chosen)
    return f"SELECT {columns} FROM {source}" + (f" WHERE {where}" if where else "")


EVENTS = drawn("events", "event_id")
FLAT = [*ENVELOPE_FIELDS, *NAMED_PAYLOAD_FIELDS, *key_names()]


def encoded_events() -> str:
    fields = event_record()
    payload = ", ".join(f"'{n}': {fields[n]}" for n in fields if n not in ENVELOPE_FIELDS)
    envelope = ", ".join(f"'{n}': {fields[n]}" for n in ENVELOPE_FIELDS)
    return (
        f"SELECT event_id, CAST(to_json({{{envelope}, 'data': {{{payload}}}}}) AS VARCHAR) "
        f"AS value FROM {EVENTS}"
    )


def kept_event_messages() -> str:
    return f"""
        SELECT CASE WHEN {KIND} = '9'
                    THEN concat('{{"eventTime":0,"eventTime":', {MILLIS}, ',"message":"',
                                event_type, '"}}')
                    WHEN {KIND} = 'a'
                    THEN concat('{{"eventTime":', {MILLIS}, ',"message":"', event_type,
                                '","deep":', repeat('[', 1100), repeat(']', 1100), '}}')
                    WHEN {KIND} = 'b'
                    THEN concat('{{"eventTime":', {MILLIS}, ',"message":"', event_type,
                                '","long":', repeat('1', 1100), '}}')
                    ELSE concat('{{"eventTime":', {MILLIS}, ',"message":"', event_type,
                                '","props":', props, '}}') END AS value
        FROM events WHERE {KIND} IN ('9', 'a', 'b', 'c', 'd', 'e', 'f')"""


def null_shares() -> str:
    fields = event_record()
    names = [name for name in fields if name not in ENVELOPE_FIELDS]
    counts = ", ".join(f'count(*) - count({fields[name]}) AS "{name}"' for name in names)
    columns = ", ".join(f'"{name}"' for name in names)
    return (
        f"SELECT key, null_count FROM (UNPIVOT (SELECT {counts} FROM {EVENTS}) "
        f"ON {columns} INTO NAME key VALUE null_count)"
    )


def cut_texts() -> str:
    cut = "substr(md5(concat(doc_id, '#cut')), 1, 1) < '8'"
    return (
        f"SELECT doc_id, CASE WHEN {cut} THEN chr(65533) ELSE right(text, 1) END AS replaced_end,"
        f" CASE WHEN NOT {cut} THEN text END AS valid_text,"
        " CAST(octet_length(encode(text)) AS INTEGER) AS kept_bytes FROM documents"
    )


# Event time. A stream's windows are final when the last watermark, an hour behind the last event, has passed them.
HOUR_US = 3_600_000_000
FINAL = f"(SELECT epoch_us(max(ts)) - {HOUR_US} FROM events)"


def tumbling() -> str:
    return f"""
        SELECT start_us, start_us + 6 * {HOUR_US} AS end_us, event_type, count(*) AS n, min(event_id) AS least_id,
               CAST(sum(user_id) AS BIGINT) AS user_sum
        FROM (SELECT *, epoch_us(ts) // (6 * {HOUR_US}) * (6 * {HOUR_US}) AS start_us FROM events WHERE ts IS NOT NULL)
        WHERE start_us + 6 * {HOUR_US} <= {FINAL} GROUP BY start_us, event_type"""


def sliding() -> str:
    return f"""
        SELECT start_us, start_us + 6 * {HOUR_US} AS end_us, event_type, count(*) AS n
        FROM (SELECT event_type, (epoch_us(ts) // (2 * {HOUR_US}) - back) * (2 * {HOUR_US}) AS start_us
              FROM events, (VALUES (0), (1), (2)) AS earlier(back) WHERE ts IS NOT NULL)
        WHERE start_us + 6 * {HOUR_US} <= {FINAL} GROUP BY start_us, event_type"""


def sessions() -> str:
    gap = 12 * HOUR_US
    return f"""
        SELECT min(us) AS start_us, max(us) + {gap} AS end_us, user_id, count(*) AS n, max(event_id) AS greatest_id
        FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS session
              FROM (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) <= {gap}
                                   THEN 0 ELSE 1 END AS opens
                    FROM (SELECT user_id, event_id, epoch_us(ts) AS us FROM events WHERE ts IS NOT NULL)))
        GROUP BY user_id, session HAVING max(us) + {gap} <= {FINAL}"""


def interval_join() -> str:
    return f"""
        SELECT c.event_id AS click_id, p.event_id AS purchase_id, epoch_us(p.ts) - epoch_us(c.ts) AS wait_us
        FROM events c JOIN events p ON c.user_id = p.user_id
        WHERE c.event_type = 'click' AND p.event_type = 'purchase'
              AND epoch_us(p.ts) - epoch_us(c.ts) BETWEEN 0 AND 6 * {HOUR_US}"""


# Sequences and outliers.
_ORDERED = "(SELECT *, row_number() OVER (ORDER BY ts, event_id) AS place FROM events WHERE ts IS NOT NULL)"
_CENTS = "CAST(round(value / 0.01) AS HUGEINT)"


def sequence() -> str:
    return f"""
        SELECT c.user_id, c.event_id AS step_1, v.event_id AS step_2, p.event_id AS step_3
        FROM (SELECT * FROM {_ORDERED} WHERE event_type = 'click') c
        ASOF JOIN (SELECT * FROM {_ORDERED} WHERE event_type = 'view') v ON c.user_id = v.user_id AND v.place > c.place
        ASOF JOIN (SELECT * FROM {_ORDERED} WHERE event_type = 'purchase') p
            ON v.user_id = p.user_id AND p.place > v.place
        WHERE epoch_us(p.ts) - epoch_us(c.ts) <= 48 * {HOUR_US}"""


def next_to_each_other() -> str:
    return f"""
        SELECT user_id, event_id AS step_1, following AS step_2
        FROM (SELECT *, lead(event_id) OVER w AS following, lead(event_type) OVER w AS then_type, lead(ts) OVER w AS then_ts
              FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        WHERE event_type = 'error' AND then_type = 'error' AND epoch_us(then_ts) - epoch_us(ts) <= 24 * {HOUR_US}"""


def event_moments() -> str:
    return f"""
        SELECT event_type, count(*) AS n, CAST(sum({_CENTS}) AS BIGINT) AS s,
               CAST(sum({_CENTS} * {_CENTS}) AS VARCHAR) AS q
        FROM events WHERE value IS NOT NULL GROUP BY event_type"""


def anomalies() -> str:
    return f"""
        WITH valued AS (SELECT event_id, event_type, {_CENTS} AS x, epoch_us(ts) // (24 * {HOUR_US}) AS day
                        FROM events WHERE value IS NOT NULL AND ts IS NOT NULL AND event_type IS NOT NULL),
             past AS (SELECT e.event_type, e.day, sum(d.n) AS n, sum(d.s) AS s, sum(d.q) AS q
                      FROM (SELECT DISTINCT event_type, day FROM valued) e
                      JOIN (SELECT event_type, day, CAST(count(*) AS HUGEINT) AS n, CAST(sum(x) AS HUGEINT) AS s,
                                   CAST(sum(x * x) AS HUGEINT) AS q FROM valued GROUP BY event_type, day) d
                          ON d.event_type = e.event_type AND d.day BETWEEN e.day - 7 AND e.day - 1
                      GROUP BY e.event_type, e.day)
        SELECT event_id, event_type, CAST(n AS BIGINT) AS past_n FROM valued JOIN past USING (event_type, day)
        WHERE n >= 10 AND (n * x - s) * (n * x - s) > 9 * (n * q - s * s)"""
