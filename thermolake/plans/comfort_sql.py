"""The comfort temperature in DuckDB SQL: both searches as recursive queries, one evaluation of the balance a round.

It shares nothing with the solver but the published equations and their constants, so that the two hold each
other. COMFORT gives CTEs up to `pets` (t, mrt, v, rh, pet) over a CTE `clean` of hourly weather.
"""

from __future__ import annotations


def _vapour(t: str) -> str:
    return f"6.11 * pow(10, 7.45 * ({t}) / (235 + ({t})))"


def _fourth(t: str) -> str:
    return f"pow(({t}) + 273.2, 4)"


def _moisture(wanted: str, lack: str, hc: str, resistance: str) -> tuple[str, str]:
    """Heat of sweat and of diffusion."""
    most = f"(0.633 * {hc} / (1013.25 * 1010) * {lack} * area * 2.42e6 / (1 + 0.92 * {hc} * {resistance}))"
    return f"least(greatest({wanted}, {most}), 0)", f"2.42e6 / 0.79e7 * area * (1 - least({wanted} / {most}, 1)) * {lack}"


def _breath(air: str, vpa: str) -> str:
    return f"heat * 1.44e-6 * (1010 * ({air} - (0.47 * {air} + 21)) + 0.623 * 2.42e6 / 1013.25 * ({vpa} - {_vapour(f'0.47 * {air} + 21')}))"


def _dry(air: str, radiant: str, skin: str, cloth: str, hc: str, share: str, clad: str) -> str:
    bare, around = f"area * (1 - {share})", _fourth(radiant)
    return f"0.725 * 5.67e-8 * ({bare} * 0.99 * ({around} - {_fourth(skin)}) + {clad} * 0.95 * ({around} - {_fourth(cloth)})) + {hc} * ({bare} * ({air} - {skin}) + {clad} * ({air} - {cloth}))"


_COVERED = "least(1, (173.51 * {0} - 2.36 - 100.76 * pow({0}, 2) + 19.28 * pow({0}, 3)) / 100)"
_ESW, _DIFFUSION = _moisture("wanted", "lack", "hc", "resistance")
_ROOM_ESW, _ROOM_DIFFUSION = _moisture("esw", "(12 - (" + _vapour("skin") + "))", "room_hc", "(0.155 * 0.9)")

#: 75 kg, 1.80 m, 35 years, male, activity 80, clothing 0.5 in the real surroundings and 0.9 in the room.
BODY = f"""body AS (SELECT *, heat AS made, area * 1.06 * 3640 AS flow, 5.28 * area AS conduct, area * share + 0.31 * icl * area AS clad, icl / 6.45 AS resistance,
    area * room_share + 0.31 * 0.9 * area AS room_clad, 2.67 + 6.5 * pow(0.1::DOUBLE, 0.67) AS room_hc,
    6.28 * 1.8 * 0.5 AS side FROM (SELECT 0.5::DOUBLE AS icl, 0.203 * pow(75::DOUBLE, 0.425) * pow(1.8::DOUBLE, 0.725) AS area, {_COVERED.format("0.5::DOUBLE")} AS share, {_COVERED.format("0.9::DOUBLE")} AS room_share,
    80 + 3.45 * pow(75::DOUBLE, 0.75) * (1 + 0.004 * (30 - 35) + 0.01 * (180 / pow(75::DOUBLE, 1.0::DOUBLE / 3) - 43.4)) AS heat)),
tuples AS (SELECT DISTINCT round_even(t * 2, 0) / 2 AS t, round_even(mrt * 2, 0) / 2 AS mrt, round_even(v * 2, 0) / 2 AS v, round_even(rh * 2, 0) / 2 AS rh FROM clean),
around AS (SELECT *, heat + {_breath("t", "vpa")} AS produced, side * (outer_r - inner_r) / (icl / 6.45 * ln(outer_r / inner_r) * clad) AS transfer FROM (
    SELECT *, 2.67 + 6.5 * pow(v, 0.67) AS hc, rh / 100 * ({_vapour("t")}) AS vpa, share * area / side AS inner_r, share * area / side + 0.31 * icl * area / side AS outer_r FROM tuples, body))"""

#: One round: the balance at x for each way the blood may flow (0 growing with the core, 2 at rest, 3 at its most).
_SKIN = f"(hc * (x - t) + 0.725 * 0.95 * 5.67e-8 * ({_fourth('x')} - {_fourth('mrt')})) / transfer + x"
WALK = f"""walk AS (
  SELECT t, mrt, v, rh, way, (t + mrt + 34) / 3 AS x, 0 AS size, 0 AS nth, 0::DOUBLE AS before, 0::DOUBLE AS root, false AS is_real, 0::DOUBLE AS skin, 0::DOUBLE AS core, 0::DOUBLE AS esw FROM tuples, (SELECT unnest([0, 2, 3]) AS way)
  UNION ALL
  SELECT t, mrt, v, rh, way, x + pow(0.1::DOUBLE, size) * sign(total), CASE WHEN goes AND nth < 99 THEN size ELSE size + 1 END, CASE WHEN goes AND nth < 99 THEN nth + 1 ELSE 0 END, CASE WHEN goes AND nth < 99 THEN total ELSE 0 END, root, is_real, skin, core, esw
  FROM (SELECT *, (sign(total) * sign(before) >= 0 AND total <> 0) OR (total = 0 AND before = 0) AS goes FROM (
    SELECT *, produced + diffusion + esw + {_dry("t", "mrt", "skin", "x", "hc", "share", "clad")} AS total FROM (
      SELECT *, {_ESW} AS esw, {_DIFFUSION} AS diffusion FROM (
        SELECT *, vpa - {_vapour("skin")} AS lack, CASE WHEN 0.1 * skin + 0.9 * core <= 0.1 * 34 + 0.9 * 36.6 THEN 0 ELSE -304.94 * (0.1 * skin + 0.9 * core - (0.1 * 34 + 0.9 * 36.6)) * area / 3600000 * 2.42e6 END AS wanted FROM (
          SELECT * EXCLUDE (skin, raw), raw_skin AS skin, CASE way WHEN 0 THEN root WHEN 2 THEN produced / (conduct + flow * (6.3 / 3600 / (1 + 0.5 * (34 - raw_skin)))) + raw_skin ELSE produced / (conduct + flow / 40) + raw END AS core FROM (
            SELECT * EXCLUDE (root, is_real, disc), CASE WHEN disc >= 0 THEN (-b + sqrt(greatest(disc, 0))) / (2 * a) ELSE root END AS root, disc >= 0 AS is_real, CASE WHEN raw = 34 THEN 34.01 ELSE raw END AS raw_skin FROM (
              SELECT *, b * b - 4 * a * (flow * 0.76275 * raw - (produced + conduct * raw)) AS disc FROM (
                SELECT *, flow * 13 / 625 AS a, conduct - flow * (0.76275 + 13.0::DOUBLE / 625 * raw) AS b FROM (
                  SELECT w.t, w.mrt, w.v, w.rh, way, x, size, nth, before, root, is_real, skin, {_SKIN.replace("(t", "(w.t").replace("- t)", "- w.t)").replace("((mrt)", "((w.mrt)")} AS raw, produced, area, share, clad, hc, vpa, resistance, transfer, conduct, flow
                  FROM (SELECT * EXCLUDE (core, esw) FROM walk WHERE size < 4) w JOIN around r ON r.t = w.t AND r.mrt = w.mrt AND r.v = w.v AND r.rh = w.rh)))))))))),
settled AS (SELECT t, mrt, v, rh, x AS cloth, skin, esw FROM walk WHERE size = 4 AND CASE way WHEN 0 THEN is_real AND NOT core >= 36.6 AND NOT skin <= 33.85 WHEN 2 THEN NOT core >= 36.6 AND NOT skin > 34 ELSE true END
  QUALIFY row_number() OVER (PARTITION BY t, mrt, v, rh ORDER BY way) = 1),
room AS (SELECT s.*, area, heat, room_hc, room_share, room_clad, {_ROOM_ESW} AS room_esw, {_ROOM_DIFFUSION} AS room_diffusion FROM settled s, body),
search AS (
  SELECT t, mrt, v, rh, t AS x, 5::DOUBLE AS step, 0::DOUBLE AS before, 0 AS nth FROM room
  UNION ALL
  SELECT t, mrt, v, rh, CASE WHEN total > 0 THEN x - step ELSE x + step END, CASE WHEN same THEN step ELSE step / 5 END, CASE WHEN same THEN total ELSE before END, CASE WHEN abs(total) > 0.01 AND nth < 399 THEN nth + 1 ELSE -1 END
  FROM (SELECT *, sign(total) * sign(before) >= 0 AS same FROM (
    SELECT q.*, heat + room_diffusion + {_breath("x", "12")} + room_esw + {_dry("x", "x", "skin", "cloth", "room_hc", "room_share", "room_clad")} AS total
    FROM (SELECT * FROM search WHERE nth >= 0) q JOIN room r ON r.t = q.t AND r.mrt = q.mrt AND r.v = q.v AND r.rh = q.rh))),
pets AS (SELECT t, mrt, v, rh, CAST(round_even(CAST(x AS FLOAT) * 2, 0) / 2 AS FLOAT) AS pet FROM search WHERE nth = -1 AND CAST(x AS FLOAT) BETWEEN -50 AND 60)"""

COMFORT = f"""{BODY},
{WALK},
hours AS (SELECT location_id, hour, c.t, c.mrt, c.v, c.rh, pet FROM (SELECT location_id, hour, round_even(t * 2, 0) / 2 AS t, round_even(mrt * 2, 0) / 2 AS mrt, round_even(v * 2, 0) / 2 AS v, round_even(rh * 2, 0) / 2 AS rh FROM clean) c JOIN pets p ON p.t = c.t AND p.mrt = c.mrt AND p.v = c.v AND p.rh = c.rh),
comfort_days AS (SELECT location_id, CAST(make_timestamp((CAST(hour AS BIGINT) * 3600 - 2208988800) * 1000000) AS DATE) AS date, max(pet) AS pet, CAST(round_even(avg(pet) * 10, 0) / 10 AS FLOAT) AS pet_avg FROM hours GROUP BY 1, 2)"""
