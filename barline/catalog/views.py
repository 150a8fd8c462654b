"""The derived views of ``sources.fixtures``, in DuckDB SQL."""

from __future__ import annotations

from barline.sources.fixtures import AS_OF, STORED_BEFORE

_LINE = "row(l_orderkey, l_linenumber, l_extendedprice)"

# name -> (views it reads, text)
VIEWS: dict[str, tuple[list[str], str]] = {
    "bars": (
        [],
        f"""SELECT 'S' || l_suppkey AS ticker, l_suppkey AS key, CAST(l_shipdate AS DATE) AS date,
            arg_min(l_extendedprice, {_LINE}) AS open, max(l_extendedprice) AS high,
            min(l_extendedprice) AS low, arg_max(l_extendedprice, {_LINE}) AS close,
            CAST(sum(l_quantity) AS BIGINT) AS volume
        FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    ),
    "payload": (
        ["bars"],
        """SELECT ticker, key, date, m,
            CASE m WHEN 0 THEN strftime(date, '%Y-%m-%d') || 'x'
                   WHEN 1 THEN strftime(date, '%Y-%-m-%-d')
                   ELSE strftime(date, '%Y-%m-%d') END AS source_date_key,
            CASE WHEN m = 2 THEN '"n/a"' ELSE
              '{"1. open":"' || CASE m WHEN 3 THEN '-1' WHEN 4 THEN printf('%.4f', high + 1)
                                       ELSE printf('%.4f', open) END
              || '","2. high":"' || CASE m WHEN 5 THEN printf('%.4f', low / 2)
                                           ELSE printf('%.4f', high) END
              || '","3. low":"' || printf('%.4f', low)
              || '","4. close":"' || CASE m WHEN 6 THEN 'abc' WHEN 7 THEN printf('%.4f', high + 1)
                                            ELSE printf('%.4f', close) END || '"'
              || CASE m WHEN 8 THEN '' WHEN 9 THEN ',"5. volume":"-5"'
                        ELSE ',"5. volume":"' || volume || '"' END || '}' END AS row_json
        FROM (SELECT *, (date_diff('day', DATE '1970-01-01', date) * 31 + key)
                        % CASE WHEN key % 10 = 9 THEN 29 ELSE 101 END AS m FROM bars)""",
    ),
    "documents_status": (
        ["bars"],
        """SELECT DISTINCT ticker, key, CASE key % 25 WHEN 7 THEN 'api_error' WHEN 8 THEN 'rate_limit'
            WHEN 9 THEN 'non_json' WHEN 10 THEN 'not_object' WHEN 11 THEN 'missing_series'
            ELSE 'ok' END AS payload_status FROM bars""",
    ),
    # Rows of the usable documents, as they come out of the JSON parse.
    "entries": (
        ["payload"],
        """SELECT ticker, key, source_date_key,
            CASE WHEN m = 2 THEN 'n/a' ELSE row_json END AS row_json
        FROM payload WHERE key % 25 NOT IN (7, 8, 9, 10, 11)""",
    ),
    "validated": (["payload"], "{validate:payload}"),
    "validated_entries": (["entries"], "{validate:entries}"),
    "predictions": (
        ["bars"],
        """SELECT * FROM (
            SELECT ticker, lag(date) OVER w AS based_on_date, date AS predicted_date,
                lag(close) OVER w AS predicted_close,
                CASE WHEN lead(date) OVER w IS NULL
                      OR (date_diff('day', DATE '1970-01-01', date) * 31 + key) % 13 = 0
                     THEN NULL ELSE close END AS actual_close,
                ticker || '_v' || year(date) AS model_version
            FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date))
        WHERE based_on_date IS NOT NULL""",
    ),
    "stored": (
        ["bars"],
        f"SELECT * FROM bars WHERE date < DATE '{STORED_BEFORE}' AND key % 10 <> 3",
    ),
    "run_log": (
        [],
        """SELECT event_type AS dag_id, CASE user_id % 10 WHEN 0 THEN 'failed' WHEN 1 THEN 'running'
            ELSE 'success' END AS state FROM events""",
    ),
    "marks": (
        ["bars", "stored"],
        f"""SELECT t.ticker, max(s.date) AS stored_until,
            coalesce(max(s.date), DATE '{AS_OF}' - 99) AS last_date
        FROM (SELECT DISTINCT ticker FROM bars) t LEFT JOIN stored s USING (ticker) GROUP BY t.ticker""",
    ),
}

# Row validation over a view with source_date_key and row_json.
_VALIDATE = """SELECT *, reject_reason IS NULL AS is_valid FROM (SELECT *, CASE
        WHEN trade_date IS NULL THEN 'invalid_date'
        WHEN NOT is_object THEN 'invalid_row_type'
        WHEN o_text IS NULL OR h_text IS NULL OR l_text IS NULL OR c_text IS NULL OR v_text IS NULL
            THEN 'missing_fields'
        WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL
            THEN 'type_conversion_error'
        WHEN least(open, high, low, close) <= 0 THEN 'non_positive_price'
        WHEN volume < 0 THEN 'negative_volume'
        WHEN high < low THEN 'high_below_low'
        WHEN NOT (open BETWEEN low AND high) THEN 'open_outside_high_low'
        WHEN NOT (close BETWEEN low AND high) THEN 'close_outside_high_low' END AS reject_reason
    FROM (SELECT * EXCLUDE (row_doc), coalesce(json_type(row_doc) = 'OBJECT', false) AS is_object,
        CAST(try_strptime(source_date_key, '%Y-%m-%d') AS DATE) AS trade_date,
        row_doc ->> '$."1. open"' AS o_text, row_doc ->> '$."2. high"' AS h_text,
        row_doc ->> '$."3. low"' AS l_text, row_doc ->> '$."4. close"' AS c_text,
        row_doc ->> '$."5. volume"' AS v_text,
        TRY_CAST(o_text AS DOUBLE) AS open, TRY_CAST(h_text AS DOUBLE) AS high,
        TRY_CAST(l_text AS DOUBLE) AS low, TRY_CAST(c_text AS DOUBLE) AS close,
        TRY_CAST(trunc(TRY_CAST(v_text AS DOUBLE)) AS BIGINT) AS volume
        FROM (SELECT *, CASE WHEN json_valid(row_json) THEN CAST(row_json AS JSON) END AS row_doc
              FROM {source})))"""

for _name in ("validated", "validated_entries"):
    _deps, _ = VIEWS[_name]
    VIEWS[_name] = (_deps, _VALIDATE.format(source=_deps[0]))


def _exact(agg: str, rows: int, value: str) -> str:
    """A rolling aggregate that is NULL until all rows of the frame have a value."""
    frame = f"(PARTITION BY ticker ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({value}) OVER {frame} = {rows} THEN {agg}({value}) OVER {frame} END"


def feature_views(source: str, suffix: str = "") -> dict[str, tuple[list[str], str]]:
    """Numbered rows, EMA recursion and all feature columns over a view of bars."""
    s, n, e = source, f"numbered{suffix}", f"averages{suffix}"
    a12, a26, a9 = "(2e0/13)", "(2e0/27)", "0.2e0"
    e12 = f"({a12} * n.close + (1 - {a12}) * e.ema_12)"
    e26 = f"({a26} * n.close + (1 - {a26}) * e.ema_26)"
    w = "(PARTITION BY ticker ORDER BY date)"
    return {
        n: (
            [s],
            f"SELECT ticker, date, close, volume, row_number() OVER {w} AS rn FROM {s}",
        ),
        e: (
            [n],
            f"""SELECT ticker, rn, close AS ema_12, close AS ema_26, CAST(0 AS DOUBLE) AS macd_signal
                FROM {n} WHERE rn = 1
                UNION ALL
                SELECT n.ticker, n.rn, {e12}, {e26},
                    {a9} * ({e12} - {e26}) + (1 - {a9}) * e.macd_signal
                FROM {e} e JOIN {n} n ON n.ticker = e.ticker AND n.rn = e.rn + 1""",
        ),
        f"moves{suffix}": (
            [n],
            f"""SELECT *, close / lag(close) OVER {w} - 1 AS daily_return,
                close - lag(close) OVER {w} AS delta,
                CASE WHEN delta IS NOT NULL THEN greatest(delta, 0) END AS up,
                CASE WHEN delta IS NOT NULL THEN greatest(-delta, 0) END AS down,
                close / lag(close, 3) OVER {w} - 1 AS return_3d,
                close / lag(close, 5) OVER {w} - 1 AS return_5d
            FROM {n}""",
        ),
        f"indicators{suffix}": (
            [f"moves{suffix}", e],
            f"""SELECT m.ticker, m.date, m.close, m.daily_return, {_exact('avg', 20, 'm.close')} AS sma_20,
                {_exact('avg', 50, 'm.close')} AS sma_50, e.ema_12, e.ema_26,
                e.ema_12 - e.ema_26 AS macd, e.macd_signal,
                100 - 100 / (1 + {_exact('avg', 14, 'm.up')} / nullif({_exact('avg', 14, 'm.down')}, 0)) AS rsi_14,
                {_exact('avg', 20, 'm.close')} + 2 * {_exact('stddev_samp', 20, 'm.close')} AS bb_upper,
                {_exact('avg', 20, 'm.close')} - 2 * {_exact('stddev_samp', 20, 'm.close')} AS bb_lower,
                {_exact('stddev_samp', 14, 'm.daily_return')} AS volatility_14,
                {_exact('avg', 20, 'm.volume')} AS volume_sma_20,
                4 * {_exact('stddev_samp', 20, 'm.close')} / {_exact('avg', 20, 'm.close')} AS bb_width,
                m.volume / {_exact('avg', 20, 'm.volume')} AS volume_ratio_20,
                m.return_3d, m.return_5d
            FROM moves{suffix} m JOIN {e} e USING (ticker, rn)""".replace(
                "PARTITION BY ticker ORDER BY date", "PARTITION BY m.ticker ORDER BY m.date"
            ),
        ),
        f"features{suffix}": (
            [f"indicators{suffix}", s],
            f"""SELECT i.* FROM indicators{suffix} i
            JOIN (SELECT ticker FROM {s} GROUP BY ticker HAVING count(*) >= 26
                  AND count(*) FILTER (close IS NULL OR volume IS NULL) / count(*) <= 0.01) USING (ticker)
            WHERE sma_50 IS NOT NULL AND rsi_14 IS NOT NULL AND volatility_14 IS NOT NULL
              AND volume_ratio_20 IS NOT NULL AND bb_width IS NOT NULL""",
        ),
    }


VIEWS.update(feature_views("bars"))


def sql(body: str, *views: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the views it needs, and by ``extra`` ones on top."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for dep in VIEWS[name][0]:
            need(dep)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        need(view)
    # A view read more than once is computed once.
    parts = [
        f"{n} AS {'' if n.startswith('averages') else 'MATERIALIZED '}({VIEWS[n][1]})" for n in ordered
    ]
    parts += [f"{n} AS ({text})" for n, text in (extra or {}).items()]
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + body


def rnd(expr: str, digits: int) -> str:
    """The counterpart of ``round_half_up``."""
    return f"floor(({expr}) * 1e{digits} + 0.5e0) / 1e{digits}"
