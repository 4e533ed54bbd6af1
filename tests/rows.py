"""Hand-made action rows."""

from __future__ import annotations

from datetime import datetime, timedelta

ACTION_SCHEMA = (
    "date string, user_id bigint, session_id string, page_id bigint, action_time string,"
    " search_keyword string, click_category_id bigint, click_product_id bigint,"
    " order_category_ids string, order_product_ids string, pay_category_ids string,"
    " pay_product_ids string, city_id bigint"
)
_NAMES = [part.split()[0] for part in ACTION_SCHEMA.split(", ")]
START = datetime(2024, 3, 1, 10, 0, 0)


def action(session="s", second=0, user=1, page=1, **fields):
    moment = START + timedelta(seconds=second)
    row = dict.fromkeys(_NAMES)
    row.update(
        date=moment.strftime("%Y-%m-%d"),
        user_id=user,
        session_id=session,
        page_id=page,
        action_time=moment.strftime("%Y-%m-%d %H:%M:%S"),
        city_id=0,
    )
    row.update(fields)
    return tuple(row[name] for name in _NAMES)


def actions(spark, rows):
    return spark.createDataFrame(rows, ACTION_SCHEMA)
