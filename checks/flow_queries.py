"""Flow products: Spark queries and SQL twins."""

from __future__ import annotations

import datetime as dt

from loantide.functions.dates import month_pairs
from loantide.plans import flows

from . import params as P
from . import views as V
from .duck_views import flow7, flow7_name, query, snapshot

OB, CB = P.OPENING, P.CLOSING
PAIRS = month_pairs(P.AS_OF, 4)
PAIR_DAYS = sorted({d for pair in PAIRS for d in pair})
DAILY_OB, DAILY_CB = dt.date(2000, 6, 28), dt.date(2000, 6, 29)


def flow_rate(spark, sf):
    return flows.flow_rate(V.snapshot(spark, sf, OB), V.snapshot(spark, sf, CB, with_shop=False), OB, CB)


def flow_history(spark, sf):
    return flows.flow_history(V.panel(spark, sf, PAIR_DAYS), P.AS_OF, 4)


def flow_detail(spark, sf):
    return flows.flow_detail(V.snapshot(spark, sf, OB), V.snapshot(spark, sf, CB, with_shop=False),
                             V.shops(spark, sf), OB, CB)


def rolled_per_shop(spark, sf):
    return flows.rolled_per_shop(V.snapshot(spark, sf, OB), V.snapshot(spark, sf, CB, with_shop=False), OB, CB)


def rolled_history(spark, sf):
    return flows.rolled_history(V.panel(spark, sf, PAIR_DAYS), P.AS_OF, 4)


def flow_matrix(spark, sf):
    return flows.flow_matrix(V.snapshot(spark, sf, OB), V.snapshot(spark, sf, CB, with_shop=False),
                             V.shops(spark, sf), OB, CB, [1, 2])


def daily_roll(spark, sf):
    return flows.daily_roll_on(V.panel(spark, sf, [DAILY_OB, DAILY_CB]), V.shop_info(spark, sf), "2000-06-30", 2)


def bucket_profile(scheme):
    return lambda spark, sf: flows.bucket_profile(V.snapshot(spark, sf, P.AS_OF, with_shop=False), scheme)

QUERIES = {
    "flow_rate": flow_rate,
    "flow_history": flow_history,
    "flow_detail": flow_detail,
    "rolled_per_shop": rolled_per_shop,
    "rolled_history": rolled_history,
    "flow_matrix": flow_matrix,
    "daily_roll": daily_roll,
    "bucket_profile_flow7": bucket_profile("flow7"),
    "bucket_profile_chip6": bucket_profile("chip6"),
    "bucket_profile_daily2": bucket_profile("daily2"),
}

TITLE_FILTER = "categoryname LIKE '%Đăng ký%' AND shopcode NOT LIKE '%TEST%' AND shopcode NOT LIKE '%HS%'"
CODE_FILTER = ("(categorycode LIKE '%17%' OR categorycode LIKE '%15%') AND shopcode NOT LIKE '%TEST%' "
               "AND shopcode NOT LIKE '%HS%'")


def _moves(ob, cb, where):
    cb_bucket = f"CASE WHEN c.tuoino IS NULL THEN -1 ELSE {flow7('c.tuoino')} END"
    return f"""
        SELECT o.*, DATE '{ob}' AS ob_date, DATE '{cb}' AS cb_date, o.tuoino AS ob_dpd, c.tuoino AS cb_dpd,
               {flow7('o.tuoino')} AS ob_bucket, {cb_bucket} AS cb_bucket,
               CASE WHEN {cb_bucket} > {flow7('o.tuoino')} THEN 'Rolled'
                    WHEN {cb_bucket} = {flow7('o.tuoino')} THEN 'Stuck' ELSE 'Cured' END AS flow
        FROM {snapshot(ob)} o LEFT JOIN {snapshot(cb, 'contract_core')} c ON c.pawnid = o.pawnid
        WHERE {where.replace('categoryname', 'o.categoryname').replace('categorycode', 'o.categorycode')}"""


def _shares(group):
    """What moved out of each opening bucket of a group, beside the whole of the bucket, both aggregated by themselves."""
    keys = f"ob_date, {group}, ob_bucket"
    return f"""
    WITH whole AS (SELECT {keys}, sum(currentmoney) AS opened, count(pawnid) AS n_opened FROM moves GROUP BY {keys}),
    parts AS (SELECT {keys}, cb_date, flow, sum(currentmoney) AS moved, count(pawnid) AS n_moved FROM moves GROUP BY {keys}, cb_date, flow)
    SELECT parts.*, opened, n_opened, CAST(moved AS DOUBLE) / CAST(opened AS DOUBLE) AS share
    FROM parts JOIN whole ON whole.ob_date = parts.ob_date AND whole.ob_bucket = parts.ob_bucket
                         AND whole.{group} IS NOT DISTINCT FROM parts.{group}"""


_RATE_BODY = f"""
    SELECT CAST(ob_date AS VARCHAR) AS from_date, CAST(cb_date AS VARCHAR) AS to_date, categoryname, flow,
           {flow7_name('ob_bucket')} AS ob_bucket_name, round(CAST(opened AS DOUBLE) / 1000000, 6) AS ob_bal,
           round(CAST(moved AS DOUBLE) / 1000000, 6) AS transit_bal, round(share, 6) AS flow_rate, n_opened AS ob_pawn,
           n_moved AS transit_pawn_count
    FROM ({_shares('categoryname')})"""

_ROLLED_BODY = f"""
    SELECT CAST(ob_date AS VARCHAR) AS ob_date, CAST(cb_date AS VARCHAR) AS cb_date, shopname, CAST(ob_bucket AS BIGINT) AS ob_bucket,
           flow, CAST(moved AS DOUBLE) AS balance, CAST(opened AS DOUBLE) AS bucket_bal, n_opened AS bucket_pawn_count,
           n_moved AS pawn_count, round(share, 6) AS flow_rate_bal, round(n_moved / n_opened, 6) AS flow_rate_pawn_count
    FROM ({_shares('shopname')})
    WHERE ob_bucket = 0 AND flow = 'Rolled'"""

_ALL_PAIRS = " UNION ALL ".join(_moves(ob, cb, TITLE_FILTER) for ob, cb in PAIRS)
_ALL_PAIRS_CODES = " UNION ALL ".join(_moves(ob, cb, CODE_FILTER) for ob, cb in PAIRS)


def _money(name):
    return f"CAST({name} AS DOUBLE)"


def _cells():
    out = []
    for a in (1, 2):
        for f in ("Cured", "Stuck", "Rolled"):
            out.append(f"sum(CASE WHEN areaid = {a} AND flow = '{f}' THEN currentmoney ELSE 0 END) AS {f.lower()}_{a}")
    return ", ".join(out)


_DAILY = f"""
    SELECT o.*, CASE WHEN c.tuoino IS NULL THEN 'Closed' WHEN c.tuoino < 11 THEN 'Stuck' ELSE 'Rolled' END AS flow,
           o.categoryname LIKE '%Đăng ký%' AS title
    FROM {snapshot(str(DAILY_OB))} o LEFT JOIN {snapshot(str(DAILY_CB), 'contract_core')} c ON c.pawnid = o.pawnid
    WHERE o.categoryname NOT LIKE '%vị%' AND shopcode NOT LIKE '%TEST%' AND shopcode NOT LIKE '%HS%' AND o.tuoino < 11"""


def _part(test, name):
    return f"CAST(sum(CASE WHEN {test} THEN currentmoney ELSE 0 END) AS DOUBLE) AS {name}"


def _profile(ordinal, label):
    return query(f"""
    SELECT {ordinal} AS bucket_no, {label} AS bucket, count(pawnid) AS pawn_count,
           CAST(sum(currentmoney) AS DOUBLE) AS balance
    FROM {snapshot(P.AS_OF, 'contract_core')} GROUP BY 1, 2""")


_CHIP6 = ("CASE WHEN tuoino < 1 THEN {0} WHEN tuoino < 31 THEN {1} WHEN tuoino < 61 THEN {2} "
          "WHEN tuoino < 91 THEN {3} WHEN tuoino < 121 THEN {4} ELSE {5} END")

SQL = {
    "flow_rate": query(_RATE_BODY, moves=_moves(OB, CB, TITLE_FILTER)),
    "flow_history": query(_RATE_BODY, moves=_ALL_PAIRS),
    "flow_detail": query(f"""
        SELECT CAST(ob_date AS VARCHAR) AS ob_date, CAST(cb_date AS VARCHAR) AS cb_date, areaid, categoryname, pawnid,
               contractcode, chipserial, CAST(fromdate AS VARCHAR) AS fromdate,
               CAST(strftime(fromdate, '%Y%m') AS BIGINT) AS brr_ym, frequency // 30 AS duration, principalpaymentday,
               CASE WHEN papertype LIKE 'KT1' THEN papertype ELSE 'KT3' END AS kt,
               CAST(currentmoney AS DOUBLE) AS currentmoney, shopname, shopcode,
               CASE WHEN packagecode IS NULL THEN 'Vay thường' ELSE packagecode END AS package_type, ob_dpd, cb_dpd,
               ob_bucket, {flow7_name('ob_bucket')} AS ob_bucket_name, cb_bucket, {flow7_name('cb_bucket')} AS cb_bucket_name,
               CAST(sum(currentmoney) OVER (PARTITION BY shopname, ob_bucket) AS DOUBLE) AS ob_bucket_bal,
               count(pawnid) OVER (PARTITION BY shopname, ob_bucket) AS ob_bucket_pawn_count, flow
        FROM moves LEFT JOIN shops ON shops.name = moves.shopname""", moves=_moves(OB, CB, TITLE_FILTER)),
    "rolled_per_shop": query(_ROLLED_BODY, moves=_moves(OB, CB, CODE_FILTER)),
    "rolled_history": query(_ROLLED_BODY, moves=_ALL_PAIRS_CODES),
    "flow_matrix": query(f"""
        SELECT CAST(ob_date AS VARCHAR) AS ob_date, CAST(cb_date AS VARCHAR) AS cb_date, ob_bucket_name,
               {', '.join(f'{_money(f"{f}_{a}")} AS {f}_{a}' for a in (1, 2) for f in ('cured', 'stuck', 'rolled'))},
               {', '.join(f'CAST({f}_1 + {f}_2 AS DOUBLE) AS {f}_all' for f in ('cured', 'stuck', 'rolled'))},
               {', '.join(f'CAST(cured_{a} + stuck_{a} + rolled_{a} AS DOUBLE) AS ob_bal_{a}' for a in (1, 2))},
               CAST(cured_1 + stuck_1 + rolled_1 + cured_2 + stuck_2 + rolled_2 AS DOUBLE) AS ob_bal_all,
               {', '.join(f'round(CAST(rolled_{a} AS DOUBLE) / nullif(CAST(cured_{a} + stuck_{a} + rolled_{a} AS DOUBLE), 0), 6) AS rolled_rate_{a}' for a in (1, 2))},
               round(CAST(rolled_1 + rolled_2 AS DOUBLE) /
                     nullif(CAST(cured_1 + stuck_1 + rolled_1 + cured_2 + stuck_2 + rolled_2 AS DOUBLE), 0), 6) AS rolled_rate_all
        FROM (SELECT ob_date, cb_date, {flow7_name('ob_bucket')} AS ob_bucket_name, {_cells()}
              FROM moves LEFT JOIN shops ON shops.name = moves.shopname
              WHERE areaid IS NOT NULL GROUP BY 1, 2, 3)""", moves=_moves(OB, CB, TITLE_FILTER)),
    "daily_roll": query(f"""
        SELECT '{DAILY_OB}' AS ob_date, '{DAILY_CB}' AS cb_date, m.*, region, province, opened_month, opened_year
        FROM (SELECT shopcode, shopname, CAST(sum(currentmoney) AS DOUBLE) AS total_bal,
                     {_part('title', 'title_bal')}, {_part('NOT title', 'normal_bal')},
                     {_part("flow = 'Closed'", 'total_close_bal')}, {_part("flow = 'Closed' AND title", 'title_closed_bal')},
                     {_part("flow = 'Closed' AND NOT title", 'normal_closed_bal')},
                     {_part("flow = 'Rolled'", 'total_rolled_bal')}, {_part("flow = 'Rolled' AND title", 'title_rolled_bal')},
                     {_part("flow = 'Rolled' AND NOT title", 'normal_rolled_bal')}
              FROM moves GROUP BY shopcode, shopname) m
        LEFT JOIN shop_info USING (shopcode)""", moves=_DAILY),
    "bucket_profile_flow7": _profile(flow7("tuoino"), flow7_name(f"({flow7('tuoino')})")),
    "bucket_profile_chip6": _profile(
        _CHIP6.format(0, 1, 2, 3, 4, 5),
        _CHIP6.format("'1.Trong hạn'", "'2.1-30'", "'3.31-60'", "'4.61-90'", "'5.91-120'", "'6.>120'")),
    "bucket_profile_daily2": _profile("CASE WHEN tuoino < 11 THEN 0 ELSE 1 END", "CASE WHEN tuoino < 11 THEN '0' ELSE '1' END"),
}
