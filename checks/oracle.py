"""The same results as plain SQL for DuckDB, written row by row and pair by pair.

Nothing here is tiled, chunked, pre-aggregated or nested: forecasts stay flat, geometry compares
every cell with every county, and events use one window per county.
"""

from __future__ import annotations

import re

from stormledger.schemas import MODEL_FEATURES

from . import fixtures as FX

CFG = FX.CFG
LEADS = (24, 30, 36, 42, 48)
TARGETS = ", ".join(f"'{f}'" for f in CFG.county_fips)
WANTED = ", ".join(str(n) for n in CFG.lead_hours)
# Days from the start less 48 hours to the end, each at midnight.
INITS = "select unnest(generate_series(timestamp '2023-12-30', timestamp '2024-01-31', interval 1 day))"
SPAN = f"timestamp '{CFG.start}' and timestamp '{CFG.end}' - interval 1 microsecond"


def block_end(ts: str) -> str:
    return f"date_trunc('day', {ts}) + to_hours(cast(6 * (hour({ts}) // 6) + 6 as integer))"


def minutes(a: str, b: str) -> str:
    return f"date_sub('minute', {a}, {b})"


def distance(half: str) -> str:
    """Squared metres from a cell box (or its centre) to a county box."""
    return (
        f"pow(greatest(0e0, w.lon - {half} - c.lon1, c.lon0 - w.lon - {half}) * 111320e0 * cos(radians(w.lat)), 2)"
        f" + pow(greatest(0e0, w.lat - {half} - c.lat1, c.lat0 - w.lat - {half}) * 111320e0, 2)"
    )


def r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) as {c.split('.')[-1]}" for c in columns)


def end_distance(p: str, t: int, q: str) -> str:
    """Squared metres from an end of side p to side q."""
    gx, gy = f"({p}x + {t} * {p}dx - {q}x)", f"({p}y + {t} * {p}dy - {q}y)"
    place = f"greatest(0e0, least(1e0, ({gx} * {q}dx + {gy} * {q}dy) / ({q}dx * {q}dx + {q}dy * {q}dy)))"
    return f"pow({gx} - {place} * {q}dx, 2) + pow({gy} - {place} * {q}dy, 2)"


def parted(p: str, q: str) -> str:
    """Whether the line through side p has the ends of side q on both its sides."""
    ends = [f"({p}dx * ({q}y + {t} * {q}dy - {p}y) - {p}dy * ({q}x + {t} * {q}dx - {p}x))" for t in (0, 1)]
    return f"{ends[0]} * {ends[1]} < 0"


BOX_DISTANCE = "pow(gap_x, 2) + pow(gap_y, 2)"
CROSSING = f"{parted('p', 'q')} and {parted('q', 'p')}"
RADIUS2 = f"{CFG.spatial_buffer_m}e0 * {CFG.spatial_buffer_m}e0".replace(".0e0", "e0")
CORNERS_NEAR = "least(" + ", ".join(end_distance(p, t, q) for p, q in ("pq", "qp") for t in (0, 1)) + f") <= {RADIUS2}"
WIND = "(ws10_max_mps >= p90_ws10 or ws925_max_mps >= p90_ws925 or shear_0_6km_max_mps >= p90_shear)"
HAIL = f"(t700_c_min <= {CFG.hail_temp_threshold}e0 and tp6_mm_max >= {CFG.hail_precip_threshold}e0)"


def n(condition: str) -> str:
    return f"count(*) filter (where {condition})"


# Named building blocks; each may use those above it.
# The weighted log loss of held-out rows under margins f0 and f1.
_LOSS = "2e0 * (" + " + ".join(
    f"pos{k}_test * ln(1 + exp(-2e0 * f{k})) + neg{k}_test * ln(1 + exp(2e0 * f{k}))" for k in (0, 1)
) + ") / (pos0_test + neg0_test + pos1_test + neg1_test)"
_STEPPED = [
    f"f{k} + {CFG.ml_learn_rate}e0 * 4e0 * (pos{k}_train / (1 + exp(2e0 * f{k})) - neg{k}_train / (1 + exp(-2e0 * f{k})))"
    f" / (pos{k}_train + neg{k}_train)"
    for k in (0, 1)
]

PARTS: dict[str, str] = {
    "fx_counties": FX.duck_sql(FX.COUNTIES),
    "fx_states": FX.duck_sql(FX.STATES),
    "fx_raw": FX.duck_sql(FX.OUTAGE_RAW),
    "fx_flat": FX.duck_sql(FX.FORECAST_FLAT),
    "readings": """
        select lpad(cast(fips_code as varchar), 5, '0') as county_fips, county, state, customers_out, total_customers,
               customers_out * 1e0 / nullif(total_customers, 0) as outage_ratio, run_start_time as ts
        from fx_raw""",
    "ref": """
        select county_fips_code, state_fips_code, state_name, county_name, lon0, lat0, lon1, lat1
        from fx_counties left join fx_states using (state_fips_code)""",
    "targets": f"select * from ref where county_fips_code in ({TARGETS})",
    "cells": "select distinct cell_id, lon, lat from fx_flat",
    "pairs": f"""
        select w.cell_id, w.lon, w.lat, c.county_fips_code as county_fips, c.county_name
        from cells w join targets c on {distance("0.125e0")} <= {RADIUS2}""",
    # An L is two boxes that overlap; each row is a side of a tilted cell beside one of them.
    "tilted_sides": f"""
        select w.cell_id, c.county_fips_code as county_fips, part, bx0, by0, bx1, by1, w.lon as mx, w.lat as my,
               111320e0 * cos(radians(w.lat)) as kx, 111320e0 as ky,
               w.lon + d.a * {FX.TILT}e0 as x0, w.lat + d.b * {FX.TILT}e0 as y0, w.lon + d.c * {FX.TILT}e0 as x1, w.lat + d.d * {FX.TILT}e0 as y1
        from cells w join (
            select county_fips_code, 0 as part, lon0 as bx0, lat0 as by0, lon1 as bx1, (lat0 + lat1) / 2e0 as by1 from targets
            union all
            select county_fips_code, 1, lon0, lat0, (lon0 + lon1) / 2e0, lat1 from targets
        ) c on w.lon between bx0 - 5 and bx1 + 5 and w.lat between by0 - 5 and by1 + 5
        cross join (values (1, 0, 0, 1), (0, 1, -1, 0), (-1, 0, 0, -1), (0, -1, 1, 0)) d(a, b, c, d)""",
    "aoi": f"""
        select cell_id, lon, lat from cells w
        where exists (select 1 from targets c where {distance("0e0")} <= {RADIUS2})""",
    "steps": f"""
        select cell_id, init_time, valid_time, hours as lead_hours, u10, v10, u925, v925, u500, v500,
               omega700, t700_k, t850_k, tp6_m
        from fx_flat
        where init_time in ({INITS}) and hours in ({WANTED}) and valid_time between {SPAN}""",
    "cell_wx": """
        select cell_id, date_trunc('hour', valid_time) as hour_ts, lead_hours,
               sqrt(u10 * u10 + v10 * v10) as ws10_mps,
               sqrt(u925 * u925 + v925 * v925) as ws925_mps,
               sqrt((u500 - u10) * (u500 - u10) + (v500 - v10) * (v500 - v10)) as shear_0_6km_mps,
               case when omega700 < 0 then -omega700 when omega700 >= 0 then 0e0 end as updraft700_pos_pas,
               t700_k - 273.15e0 as t700_c, t850_k - 273.15e0 as t850_c,
               case when tp6_m is null then 0e0 else tp6_m * 1000e0 end as tp6_mm
        from steps""",
    "wx": """
        select p.county_fips, p.county_name, hour_ts, lead_hours,
               max(ws10_mps) as ws10_max_mps, max(ws925_mps) as ws925_max_mps,
               max(shear_0_6km_mps) as shear_0_6km_max_mps, max(updraft700_pos_pas) as updraft700_pos_max_pas,
               min(t700_c) as t700_c_min, avg(t700_c) as t700_c_mean, avg(t850_c) as t850_c_mean,
               max(tp6_mm) as tp6_mm_max, avg(tp6_mm) as tp6_mm_mean
        from cell_wx join aoi using (cell_id) join pairs p using (cell_id)
        group by all""",
    "scoped": f"select * from readings where county_fips in ({TARGETS}) and ts between {SPAN}",
    "blocks": f"""
        select county_fips, {block_end("ts")} as block_end_ts,
               max(outage_ratio) as outage_ratio_6h_max, avg(outage_ratio) as outage_ratio_6h_mean,
               max(customers_out) as customers_out_6h_max, count(*) as samples_in_block
        from scoped group by all""",
    "grid": f"""
        select county_fips_code as county_fips,
               unnest(generate_series(timestamp '{CFG.start}', timestamp '{CFG.end}', interval 6 hour)) as valid_ts
        from targets""",
    "thr": f"""
        select county_fips,
               quantile_disc(ws10_max_mps, 10e0 / 11e0) as p90_ws10,
               quantile_disc(ws925_max_mps, 10e0 / 11e0) as p90_ws925,
               quantile_disc(shear_0_6km_max_mps, 10e0 / 11e0) as p90_shear,
               quantile_disc(updraft700_pos_max_pas, 0.8e0) as p80_updraft
        from wx where hour_ts between {SPAN} group by county_fips""",
    "master": f"""
        select g.county_fips, g.valid_ts, w.lead_hours, w.ws10_max_mps, w.ws925_max_mps, w.shear_0_6km_max_mps,
               w.updraft700_pos_max_pas, w.t700_c_min, w.t700_c_mean, w.t850_c_mean, w.tp6_mm_mean, w.tp6_mm_max,
               cast(coalesce({HAIL}, false) as bigint) as hail_flag,
               e.outage_ratio_6h_max, e.outage_ratio_6h_mean, e.samples_in_block, e.customers_out_6h_max
        from grid g
        left join wx w on (w.county_fips, w.hour_ts) = (g.county_fips, g.valid_ts)
        left join blocks e on (e.county_fips, e.block_end_ts) = (g.county_fips, g.valid_ts)""",
    "ordered": f"""
        select *, outage_ratio >= {CFG.event_outage_threshold}e0 as is_on,
               lag(ts) over seq as prev_ts,
               lag(outage_ratio >= {CFG.event_outage_threshold}e0) over seq as prev_on
        from scoped window seq as (partition by county_fips order by ts, outage_ratio nulls first)""",
    "marked": f"""
        select *, case when is_on and (prev_on is distinct from true
                                       or {minutes("prev_ts", "ts")} > {CFG.event_gap_minutes})
                  then 1 else 0 end as starts
        from ordered""",
    "numbered": """
        select *, sum(starts) over (partition by county_fips order by ts, outage_ratio nulls first
                                    rows unbounded preceding) as number
        from marked""",
    "events_": f"""
        select county_fips, cast(number as bigint) as event_id, min(ts) as start_ts, max(ts) as end_ts,
               {minutes("min(ts)", "max(ts)")} as duration_min, max(outage_ratio) as peak_outage
        from numbered where is_on group by county_fips, number""",
    "flagged": f"""
        select w.*, coalesce({WIND}, false) as wind, coalesce({HAIL}, false) as hail
        from wx w join thr using (county_fips) where hour_ts between {SPAN}""",
    "lead_flags": f"""
        select county_fips, hour_ts as valid_ts,
               {", ".join(f"cast(count(*) filter (where wind and lead_hours = {l}) > 0 as bigint) as wind{l}" for l in LEADS)},
               {", ".join(f"cast(count(*) filter (where hail and lead_hours = {l}) > 0 as bigint) as hail{l}" for l in LEADS)},
               min(lead_hours) filter (where wind or hail) as earliest_lead_h
        from flagged group by all""",
    "coverage": f"""
        select e.county_fips, e.event_id, e.start_ts, e.end_ts, e.duration_min, e.peak_outage,
               {", ".join(f"cast(coalesce(bool_or(f.lead_hours = {l}), false) as bigint) as dect_{l}h" for l in LEADS)},
               cast(count(f.lead_hours) > 0 as bigint) as any_flag_anylead,
               min(f.lead_hours) as earliest_lead_h
        from events_ e
        left join (select * from flagged where wind or hail) f
          on f.county_fips = e.county_fips
         and f.hour_ts between {block_end("e.start_ts")} and {block_end("e.end_ts")}
        group by all""",
    "per_time": f"""
        select county_fips, hour_ts as valid_ts, max(ws10_max_mps) as ws10_max_mps_24_48,
               {n("wind")} as wind_flags_leads, {n("hail")} as hail_flags_leads
        from flagged where lead_hours in ({WANTED}) group by all""",
    "per_day": f"""
        select d.*, coalesce(ws10_daymax >= p90_ws10, false) as windy,
               hail_consistency >= {CFG.hail_consistency_min} as icy,
               wind_consistency >= {CFG.wind_consistency_min} as agreed
        from (select county_fips, cast(valid_ts as date) as day_utc,
                     round(max(ws10_max_mps_24_48), 2) as ws10_daymax,
                     cast(sum(wind_flags_leads) as bigint) as wind_consistency,
                     cast(sum(hail_flags_leads) as bigint) as hail_consistency
              from per_time group by all) d
        join thr using (county_fips)""",
    "plan": f"""
        select county_fips, day_utc,
               case when icy or (windy and agreed) then 'HIGH' when windy then 'MEDIUM' else 'LOW' end as tier,
               ws10_daymax, wind_consistency, hail_consistency,
               concat_ws('; ', case when windy then 'wind>=county p90' end,
                         case when windy and agreed then 'multi-lead-confirmed' end,
                         case when icy then 'hail-ingredients' end) as reason_codes
        from per_day""",
    "scorable": f"""
        select * from master
        where samples_in_block >= {CFG.min_samples_per_block} and lead_hours in ({WANTED})""",
    "verdicts": f"""
        select county_fips, lead_hours, {WIND} or {HAIL} as x, outage_ratio_6h_max >= {CFG.outage_threshold}e0 as y
        from scorable join thr using (county_fips)""",
    "skill_": f"""
        select 'COMBO(W OR H)' as model, county_fips, lead_hours, count(*) as n_scored,
               {n("x and y")} as "TP", {n("x and not y")} as "FP", {n("not x and y")} as "FN", {n("not x and not y")} as "TN",
               {n("x and y")} * 1e0 / nullif({n("x")}, 0) as precision,
               {n("x and y")} * 1e0 / nullif({n("y")}, 0) as recall,
               2e0 * {n("x and y")} / nullif(2 * {n("x and y")} + {n("x <> y")}, 0) as f1
        from verdicts group by county_fips, lead_hours""",
    "corr_": """
        select county_fips, lead_hours, count(*) as n_scored,
        """
    + ", ".join(
        f"case when isnan(corr(outage_ratio_6h_max, {x})) then null else round(corr(outage_ratio_6h_max, {x}), 6) end as {name}"
        for name, x in {
            "r_ws10": "ws10_max_mps", "r_ws925": "ws925_max_mps", "r_shear": "shear_0_6km_max_mps",
            "r_updraft": "updraft700_pos_max_pas", "r_precip": "tp6_mm_max", "r_t700": "t700_c_min",
        }.items()
    )
    + " from scorable group by county_fips, lead_hours",
    "training": f"""
        select county_fips, valid_ts, ws10_max_mps, ws925_max_mps, shear_0_6km_max_mps, updraft700_pos_max_pas,
               tp6_mm_max, t700_c_min, t850_c_mean, hail_flag, lead_hours,
               cast(hour(valid_ts) as bigint) as hour_of_day, cast(dayofweek(valid_ts) + 1 as bigint) as day_of_week,
               cast(month(valid_ts) as bigint) as month,
               ws10_max_mps * tp6_mm_max as wind_precip_interaction,
               ws10_max_mps * ws10_max_mps as wind_squared,
               shear_0_6km_max_mps * updraft700_pos_max_pas as shear_updraft_interaction,
               outage_ratio_6h_max,
               cast(coalesce(outage_ratio_6h_max >= {CFG.outage_threshold}e0, false) as bigint) as outage_event,
               case cast(concat('0x', substr(md5(concat(county_fips, cast(cast(valid_ts as date) as varchar))), 1, 8))
                         as bigint) % 5
                    when 0 then 'TEST' else 'TRAIN' end as data_split
        from master
        where samples_in_block >= {CFG.min_samples_per_block} and ws10_max_mps is not null""",
    # A fixed score stands in for a model, so that evaluation arithmetic can be checked.
    "scores": """
        select county_fips, valid_ts, lead_hours, outage_ratio_6h_max as actual_ratio, outage_event as actual_event,
               case when ws10_max_mps > 60e0 then 1e0 else ws10_max_mps / 60e0 end as p
        from training where data_split = 'TEST'""",
    # One 0/1 feature: trees and logistic regression can only learn a value for either side of it.
    "one_flag": f"""
        select county_fips, valid_ts, outage_ratio_6h_max as ratio, outage_event, data_split,
               cast(ws10_max_mps >= {FX.STRONG_WIND}e0 as bigint) as flag
        from training""",
    "flag_means": """
        select flag, avg(ratio) as v, count(*) as n from one_flag where data_split = 'TRAIN' and ratio is not null group by flag""",
    # Weights make both classes weigh the same in training rows.
    "flag_weights": """
        select outage_event, (select count(*) from one_flag where data_split = 'TRAIN') / (2e0 * count(*)) as w
        from one_flag where data_split = 'TRAIN' group by outage_event""",
    "flag_sides": """
        select flag, data_split, coalesce(sum(w) filter (where outage_event = 1), 0e0) as pos,
               coalesce(sum(w) filter (where outage_event = 0), 0e0) as neg
        from one_flag join flag_weights using (outage_event) group by flag, data_split""",
    "flag_rates": "select flag, pos / (pos + neg) as v from flag_sides where data_split = 'TRAIN'",
    "flag_counts": f"""
        select {", ".join(
            f"coalesce(max({sign}) filter (where flag = {flag} and data_split = '{split}'), 0e0) as {sign}{flag}_{split.lower()}"
            for sign in ("pos", "neg") for flag in (0, 1) for split in ("TRAIN", "TEST"))}
        from flag_sides""",
    # Boosting: each tree adds the step size times the mean gradient of the log loss on its side, until
    # the loss of the held-out rows falls by less than a hundredth.
    "flag_boosts": f"""
        with recursive b(m, f0, f1, best, g0, g1, stopped) as (
            select 1, f0, f1, {_LOSS}, f0, f1, false
            from (select c.*, 2e0 * pos0_train / (pos0_train + neg0_train) - 1 as f0,
                         2e0 * pos1_train / (pos1_train + neg1_train) - 1 as f1 from flag_counts c)
            union all
            select m + 1, f0, f1, case when stops then best else least(best, loss) end,
                   case when stops or loss >= best then g0 else f0 end,
                   case when stops or loss >= best then g1 else f1 end, stops
            from (select *, best - loss < 0.01e0 * greatest(loss, 0.01e0) as stops
                  from (select *, {_LOSS} as loss
                        from (select m, best, g0, g1, {_STEPPED[0]} as f0, {_STEPPED[1]} as f1, c.*
                              from b, flag_counts c where m < {FX.FLAG_CFG.ml_max_iterations} and not stopped))))
        select flag, 1 / (1 + exp(-2e0 * case flag when 1 then g1 else g0 end)) as v
        from (select * from b order by m desc limit 1), (values (0), (1)) s(flag)""",
    "flag_ratio_scores": """
        select county_fips, valid_ts, flag, ratio as actual_ratio, v as p
        from one_flag join flag_means using (flag) where data_split = 'TEST'""",
    "flag_rate_scores": """
        select county_fips, valid_ts, outage_event as actual_event, round(v, 3) as p
        from one_flag join flag_rates using (flag) where data_split = 'TEST'""",
    "flag_boost_scores": """
        select county_fips, valid_ts, outage_event as actual_event, round(v, 3) as p
        from one_flag join flag_boosts using (flag) where data_split = 'TEST'""",
}

_NAMES = list(PARTS)


def using(select: str) -> str:
    """Prefix a SELECT with the building blocks it needs, directly or not.

    Every rounding is to 6 digits, and moved off exact ties as in the queries.
    """
    needed: set[str] = set()
    nudge = f" + {FX.NUDGE}, 6)"

    def visit(text: str) -> None:
        for name in _NAMES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(PARTS[name])

    visit(select)
    body = ",\n".join(f"{name} as materialized ({PARTS[name]})" for name in _NAMES if name in needed)
    return (f"with {body}\n{select}" if body else select).replace(", 6)", nudge)


def named(rows: str, columns: str, keep: str = "county_name, state_name") -> str:
    return f"select v.county_fips, {keep}, {columns} from {rows} v join ref on ref.county_fips_code = v.county_fips"


PLAN = "day_utc, tier, ws10_daymax, wind_consistency, hail_consistency, reason_codes"
WKT = (
    "concat('MULTIPOLYGON (((', lon0, ' ', lat0, ', ', lon1, ' ', lat0, ', ', lon1, ' ', lat1, ', ',"
    " lon0, ' ', lat1, ', ', lon0, ' ', lat0, ')))')"
)
WX_ROUNDED = f"* replace ({r6('t700_c_mean', 't850_c_mean', 'tp6_mm_mean')})"
MASTER_ROUNDED = f"* replace ({r6('t700_c_mean', 't850_c_mean', 'tp6_mm_mean', 'outage_ratio_6h_mean')})"
# Every array holds the step twice, once under a lead that nobody asks for.
BAND_SUMS = ", ".join(
    f"round(2e0 * {c}, 6) as {c}" for c in ("u10", "v10", "u925", "v925", "u500", "v500", "omega700", "t700_k", "t850_k", "tp6_m")
)


def _heat(measure: str) -> str:
    cells = ", ".join(
        f"max({measure}) filter (where lead_hours = {l}) as r_{l}h,"
        f" case when count({measure}) filter (where lead_hours = {l}) = 0 then null"
        f" when max({measure}) filter (where lead_hours = {l}) >= 0.5 then 'strong'"
        f" when max({measure}) filter (where lead_hours = {l}) >= 0.3 then 'moderate'"
        f" when max({measure}) filter (where lead_hours = {l}) >= 0.1 then 'weak' else 'none' end as band_{l}h"
        for l in LEADS
    )
    return f"""
        select county_fips, county_name, '{measure}' as measure, {cells}
        from corr_ join ref on county_fips_code = county_fips group by county_fips, county_name"""


def _sweep() -> str:
    a, b = "p >= threshold", "actual_ratio >= threshold"
    cutoffs = "(0.01e0), (0.03e0), (0.05e0), (0.1e0), (0.15e0), (0.2e0)"
    return f"""
        select threshold, count(*) as n,
               {n(f"{a} and {b}")} as "TP", {n(f"{a} and not {b}")} as "FP",
               {n(f"not {a} and {b}")} as "FN", {n(f"not {a} and not {b}")} as "TN",
               round({n(f"{a} and {b}")} * 1e0 / nullif({n(a)}, 0), 6) as precision,
               round({n(f"{a} and {b}")} * 1e0 / nullif({n(b)}, 0), 6) as recall,
               round(2e0 * {n(f"{a} and {b}")} / nullif(2 * {n(f"{a} and {b}")} + {n(f"({a}) <> ({b})")}, 0), 6) as f1
        from scores, (values {cutoffs}) c(threshold) group by threshold"""


def _auc() -> str:
    """Share of (positive, negative) pairs ordered rightly, ties counting half."""
    return """(select round(avg(case when a.p > b.p then 1e0 when a.p = b.p then 0.5e0 else 0e0 end), 6)
               from scores a join scores b on a.actual_event = 1 and b.actual_event = 0)"""


QUERIES: dict[str, str] = {
    "load_outage_csv": "select * from fx_raw",
    "outage_upsert": """
        select fips_code, run_start_time, customers_out, total_customers from fx_raw
        where fips_code is not null and run_start_time is not null
        qualify row_number() over (partition by fips_code, run_start_time order by customers_out desc nulls last, total_customers desc nulls last) = 1""",
    "outage_quarantine": """
        select fips_code, count(*) as n, sum(customers_out)::bigint as customers_out, 'read' as kind
        from fx_raw where coalesce(customers_out % 7, 1) <> 0 group by 1
        union all select fips_code, count(*), 0, 'quarantined' from fx_raw where customers_out % 7 = 0 group by 1""",
    "outage_part": "select * replace (round(outage_ratio, 6) as outage_ratio) from readings",
    "counties_ref": f"select county_fips_code, state_fips_code, state_name, county_name, {WKT} as county_geom from ref",
    "init_time_list": f"select init_time, count(*) as forecast_rows from fx_flat where init_time in ({INITS}) group by 1",
    "forecast_scan": f"""
        select cell_id, lon, lat, init_time, cast(2 as bigint) as n_steps, {BAND_SUMS} from fx_flat where init_time in ({INITS})""",
    "explode_forecast": "select * from steps",
    "cell_features": "select * from cell_wx",
    "aoi_filter": "select * from aoi",
    "spatial_join": "select cell_id, county_fips from pairs",
    "spatial_join_outlines": f"""
        select cell_id, county_fips, bool_or(centre) as centre_near
        from (
            select cell_id, county_fips, max({BOX_DISTANCE}) <= {RADIUS2} as centre,
                   bool_or({CORNERS_NEAR} or ({CROSSING})) or bool_or(w.inside or w.around) as near
            from (
                select w.*, w.x0 between bx0 and bx1 and w.y0 between by0 and by1 as inside,
                       abs(s.x0) + abs(s.y0) <= {FX.TILT}e0 as around,
                       (w.x0 - w.mx) * kx as px, (w.y0 - w.my) * ky as py, (w.x1 - w.x0) * kx as pdx, (w.y1 - w.y0) * ky as pdy,
                       s.x0 * kx as qx, s.y0 * ky as qy, (s.x1 - s.x0) * kx as qdx, (s.y1 - s.y0) * ky as qdy,
                       greatest(0e0, bx0 - w.mx, w.mx - bx1) * kx as gap_x, greatest(0e0, by0 - w.my, w.my - by1) * ky as gap_y
                from tilted_sides w, lateral (
                    select unnest([
                        {{'x0': bx0, 'y0': by0, 'x1': bx1, 'y1': by0}}, {{'x0': bx1, 'y0': by0, 'x1': bx1, 'y1': by1}},
                        {{'x0': bx1, 'y0': by1, 'x1': bx0, 'y1': by1}}, {{'x0': bx0, 'y0': by1, 'x1': bx0, 'y1': by0}}]) as e
                ) l, lateral (select e.x0 - w.mx as x0, e.y0 - w.my as y0, e.x1 - w.mx as x1, e.y1 - w.my as y1) s
            ) w
            group by cell_id, county_fips, part)
        group by cell_id, county_fips having bool_or(near)""",
    "weather_features": f"select {WX_ROUNDED} from wx",
    "outage_6h_qc": f"select * replace ({r6('outage_ratio_6h_mean')}) from blocks",
    "six_hour_grid": "select * from grid",
    "county_thresholds": "select * from thr",
    "outage_vs_weather": f"select {MASTER_ROUNDED} from master",
    "event_marks": f"""
        select county_fips, ts, count(*) as readings, max(outage_ratio) as outage_ratio,
               coalesce(bool_or(is_on), false) as outage_on,
               cast(list(case when prev_ts is not null then coalesce(prev_on, false) end
                         order by outage_ratio nulls first)[1] as varchar) as prev_outage_on,
               {minutes("min(prev_ts)", "ts")} as gap_min, cast(max(starts) as bigint) as is_start,
               cast(max(number) filter (where is_on) as bigint) as event_id
        from numbered group by county_fips, ts""",
    "outage_events": "select * from events_",
    "wx_lead_flags": "select * from lead_flags",
    "event_coverage": "select * from coverage",
    "six_hour_wind_hail_counts": "select * from per_time",
    "daily_plan": "select * from plan",
    "lead_performance": f"select * replace ({r6('precision', 'recall', 'f1')}) from skill_",
    "correlations": "select * from corr_",
    "training_data": f"select * replace ({r6('t850_c_mean')}) from training",
    "timeseries_view": named(
        "(select * from master where lead_hours is not null)",
        "valid_ts, lead_hours, outage_ratio_6h_max, ws10_max_mps, ws925_max_mps, shear_0_6km_max_mps, tp6_mm_max, hail_flag",
    ),
    "correlation_view": named(
        "corr_", "lead_hours, n_scored, r_ws10, r_ws925, r_shear, r_updraft, r_precip, r_t700", "county_name"
    ),
    "risk_map_view": named("plan", PLAN, f"county_name, state_name, {WKT} as geom"),
    "preboard_view": named("plan", PLAN),
    "events_view": named("coverage", "v.* exclude (county_fips)"),
    "kpi_overview": """
        select (select count(distinct county_fips) from plan) as counties_monitored,
               (select count(*) from plan where tier = 'HIGH') as high_risk_county_days,
               count(*) filter (where any_flag_anylead = 1) as events_detected,
               count(*) as total_events,
               round(count(*) filter (where any_flag_anylead = 1) * 1e0 / nullif(count(*), 0), 6) as detection_rate,
               cast(median(earliest_lead_h) as double) as median_earliest_lead_h
        from coverage""",
    "correlation_heatmap": " union all ".join(map(_heat, ("r_ws10", "r_ws925", "r_shear", "r_updraft", "r_precip", "r_t700"))),
    "unit_conversions": """
        select county_fips, valid_ts, lead_hours, round(ws10_max_mps * 2.237e0, 6) as ws10_mph,
               round(ws10_max_mps * 1.944e0, 6) as ws10_knots, round(outage_ratio_6h_max * 100e0, 6) as outage_pct
        from master where lead_hours is not null""",
    "evaluate_regression": """
        select round(avg(abs(actual_ratio - p)), 6) as mean_absolute_error,
               round(avg((actual_ratio - p) * (actual_ratio - p)), 6) as mean_squared_error,
               round(avg(pow(ln(1 + p) - ln(1 + actual_ratio), 2)), 6) as mean_squared_log_error,
               round(quantile_disc(abs(actual_ratio - p), 0.5), 6) as median_absolute_error,
               round(1 - avg(pow(actual_ratio - p, 2)) / var_pop(actual_ratio), 6) as r2_score,
               round(1 - var_pop(actual_ratio - p) / var_pop(actual_ratio), 6) as explained_variance
        from scores where actual_ratio is not null""",
    "evaluate_classification": f"""
        select round({n("p >= 0.5 and actual_event = 1")} * 1e0 / nullif({n("p >= 0.5")}, 0), 6) as precision,
               round({n("p >= 0.5 and actual_event = 1")} * 1e0 / nullif({n("actual_event = 1")}, 0), 6) as recall,
               round({n("(p >= 0.5) = (actual_event = 1)")} * 1e0 / count(*), 6) as accuracy,
               round(2e0 * {n("p >= 0.5 and actual_event = 1")} / nullif({n("p >= 0.5")} + {n("actual_event = 1")}, 0), 6) as f1_score,
               round(avg(-ln(case when actual_event = 1 then least(greatest(p, 1e-15), 1 - 1e-15)
                                  else 1 - least(greatest(p, 1e-15), 1 - 1e-15) end)), 6) as log_loss,
               {_auc()} as roc_auc
        from scores""",
    "confusion_matrix": f"""
        select actual_event as expected_label, {n("p < 0.5")} as "_0", {n("p >= 0.5")} as "_1"
        from scores group by actual_event""",
    "roc_curve": f"""
        select threshold,
               round({n("p >= threshold and actual_event = 1")} * 1e0 / nullif({n("actual_event = 1")}, 0), 6) as recall,
               round({n("p >= threshold and actual_event = 0")} * 1e0 / nullif({n("actual_event = 0")}, 0), 6) as false_positive_rate,
               {n("p >= threshold and actual_event = 1")} as true_positives,
               {n("p >= threshold and actual_event = 0")} as false_positives,
               {n("p < threshold and actual_event = 0")} as true_negatives,
               {n("p < threshold and actual_event = 1")} as false_negatives
        from scores, (select range * 1e0 / 100 as threshold from range(101)) group by threshold""",
    "roc_points": f"""
        select round(t, 6) as threshold,
               round({n("p >= t and actual_event = 1")} * 1e0 / nullif({n("actual_event = 1")}, 0), 6) as recall,
               round({n("p >= t and actual_event = 0")} * 1e0 / nullif({n("actual_event = 0")}, 0), 6) as false_positive_rate,
               {n("p >= t and actual_event = 1")} as true_positives,
               {n("p >= t and actual_event = 0")} as false_positives,
               {n("p < t and actual_event = 0")} as true_negatives,
               {n("p < t and actual_event = 1")} as false_negatives
        from scores, (select distinct p as t from scores) group by t""",
    "threshold_sweep": _sweep(),
}
# Fixed cutoffs of the tiers.
SEVERE, OUTAGE, HIGH, MEDIUM = 0.15, 0.05, 0.7, 0.3
_SEVERITY = "case when {0} >= {1}e0 then 'SEVERE' when {0} >= {2}e0 then 'OUTAGE' else 'NORMAL' end"
QUERIES |= {
    "train_regressor_flag": QUERIES["evaluate_regression"].replace("from scores", "from flag_ratio_scores"),
    "train_classifier_flag": QUERIES["evaluate_classification"].replace("scores", "flag_boost_scores"),
    "train_logistic_flag": QUERIES["evaluate_classification"].replace("scores", "flag_rate_scores"),
    # All families rank two sides alike, and of equal ones the first is kept.
    "model_search_flag": QUERIES["evaluate_classification"].replace("scores", "flag_rate_scores"),
    "predict_regression_flag": f"""
        select county_fips, valid_ts, round(actual_ratio, 6) as actual_ratio, round(p, 6) as predicted_ratio,
               {_SEVERITY.format("p", SEVERE, OUTAGE)} as predicted_tier from flag_ratio_scores""",
    "predict_classification_flag": f"""
        select county_fips, valid_ts, actual_event, cast(p >= 0.5 as bigint) as predicted_event, p as predicted_probability,
               {_SEVERITY.format("p", SEVERE, OUTAGE)} as predicted_tier from flag_boost_scores""",
    "batch_score_flag": """
        select county_fips, valid_ts, flag as hail_flag, outage_event, data_split, cast(v >= 0.5 as bigint) as predicted_event,
               round(v, 3) as predicted_probability from one_flag join flag_rates using (flag)""",
    "ml_risk_view_flag": f"""
        select county_fips, valid_ts, round(v, 3) as outage_probability,
               case when round(v, 3) >= {HIGH}e0 then 'HIGH' when round(v, 3) >= {MEDIUM}e0 then 'MEDIUM' else 'LOW' end as ml_risk_tier
        from one_flag join flag_rates using (flag)""",
    "feature_importance_flag": "select feature, round(case feature when 'hail_flag' then 1e0 else 0e0 end, 6) as attribution from (values "
    + ", ".join(f"('{name}')" for name in MODEL_FEATURES) + ") f(feature)",
    "attribution_flag": """
        select county_fips, valid_ts, round(p, 6) as raw_output, round(base, 6) as base, round(p - base, 6) as by_flag
        from flag_ratio_scores, (select sum(n * v) / sum(n) as base from flag_means)""",
    "attribution_sums": """
        select county_fips, valid_ts, cast(lead_hours as double) as lead_hours, 0e0 as unexplained
        from training where data_split = 'TEST'""",
}
STORED = {
    "correlation": ["weather_features", "outage_6h_qc", "county_thresholds", "outage_events", "event_coverage", "daily_plan",
                    "lead_performance", "correlations"],
    "ml-data": ["training_data"],
}
QUERIES["pipeline_runs"] = " union all ".join(
    f"select '{phase}' as phase, '{step}' as step, 'OK' as status, (select count(*) from ({QUERIES[step]})) as n_rows"
    for phase, steps in STORED.items() for step in steps
)


def portable(name: str) -> str:
    casts = ", ".join(f"cast({c} as {t}) as {c}" for c, t in FX.COMPARED_AS.get(name, {}).items())
    return f"select * replace ({casts}) from ({QUERIES[name]})" if casts else QUERIES[name]


def oracle_sql() -> dict[str, str]:
    return {name: using(portable(name)) for name, text in QUERIES.items()}
