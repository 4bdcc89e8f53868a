"""Masks, colours and shapes of square score maps as DuckDB SQL."""

from __future__ import annotations

from .descriptors import BACKGROUND_PERCENTILE, MASK_K, MASK_PERCENTILE, SMOOTH_SIGMA

_CROSS = "(values (0, 0), (0, 1), (0, -1), (1, 0), (-1, 0)) as d(dy, dx)"


def masks_sql(pixels: str, side: int, red: str, green: str, blue: str) -> str:
    """Over ``pixels``, a query of ``image_id, y, x, v`` with all pixels of maps of
    ``side`` x ``side``; the colours are expressions of ``v``. Regions come from a
    recursive walk over touching pixels, hulls from lines between all ends of rows
    (in half pixels)."""
    r, s2 = int(4 * SMOOTH_SIGMA + 0.5), 2 * side
    spread = f"greatest({red}, {green}, {blue}) - least({red}, {green}, {blue})"
    sums = lambda when: ", ".join(f"sum(case when {when} then {e} end) as {n}" for n, e in (("n", "1"), ("r", red), ("g", green), ("b", blue), ("s", spread)))
    shape = lambda e, d: f"round(case when n >= 4 then {e} else {d} end, 6)"
    return f"""with recursive px as ({pixels}),
  tap as (select k, exp(-0.5 * (k / {SMOOTH_SIGMA}) ** 2) as e from range({-r}, {r + 1}) t(k)),
  mirrored as (select i, (i + k + {s2 * (1 + r // s2)}) % {s2} as p, e / (select sum(e) from tap) as e from range({side}) t(i), tap),
  kernel as (select i, case when p < {side} then p else {s2 - 1} - p end as j, sum(e) as e from mirrored group by 1, 2),
  wide as (select image_id, y, i as x, sum(v * e) as v from px join kernel on j = x group by 1, 2, 3),
  smooth as (select image_id, i as y, x, sum(v * e) as v from wide join kernel on j = y group by 1, 2, 3),
  cuts as (select image_id, greatest(quantile_cont(v, {MASK_PERCENTILE / 100}), avg(v) + {MASK_K} * stddev_pop(v)) as high, quantile_cont(v, 0.99) as top,
    quantile_cont(v, {BACKGROUND_PERCENTILE / 100}) as half, arg_max(y * {side} + x, v) as peak from smooth group by 1),
  enough as (select c.*, case when k >= 4 then high else top end as cut from cuts c join (select image_id, count(case when v >= high then 1 end) as k from smooth join cuts using (image_id) group by 1) using (image_id)),
  grown as (select distinct image_id, y + dy as y, x + dx as x from smooth join enough using (image_id), {_CROSS} where v >= cut and y + dy between 0 and {side - 1} and x + dx between 0 and {side - 1}),
  closed as (select image_id, y + dy as y, x + dx as x, (y + dy) * {side} + x + dx as p from grown, {_CROSS} group by all having count(*) = 5),
  walk as (select image_id, p, p as q from closed
    union select w.image_id, w.p, b.p from walk w join closed b on w.image_id = b.image_id and abs(w.q // {side} - b.y) <= 1 and abs(w.q % {side} - b.x) <= 1),
  labels as (select image_id, p, min(q) as region from walk group by 1, 2),
  ranked as (select image_id, region, row_number() over (partition by image_id order by bool_or(p = peak) desc, count(*) desc, region) as k from labels join enough using (image_id) group by 1, 2),
  mask as (select image_id, p // {side} as y, p % {side} as x from labels join ranked using (image_id, region) where k = 1),
  corners as (select image_id, y2, min(x2) as l, max(x2) as r from (select image_id, 2 * y + dy as y2, 2 * x + dx as x2 from mask, {_CROSS} where dy <> 0 or dx <> 0) group by 1, 2),
  slices as (select m.image_id, m.y, min(case when a.y2 = b.y2 then a.l else a.l + (b.l - a.l) * (2 * m.y - a.y2) / (b.y2 - a.y2)::double end) / 2 as l,
    max(case when a.y2 = b.y2 then a.r else a.r + (b.r - a.r) * (2 * m.y - a.y2) / (b.y2 - a.y2)::double end) / 2 as r
    from (select distinct image_id, y from mask) m join corners a on a.image_id = m.image_id and a.y2 <= 2 * m.y join corners b on b.image_id = m.image_id and b.y2 >= 2 * m.y group by 1, 2),
  hull as (select image_id, sum(floor(r + 1e-9) - ceil(l - 1e-9) + 1) as hull from slices group by 1),
  box as (select image_id, count(*) as n, max(y) - min(y) + 1 as tall, max(x) - min(x) + 1 as wide, var_pop(y) + 1 / 12 as yy, var_pop(x) + 1 / 12 as xx, covar_pop(x, y) as xy from mask group by 1),
  axes as (select *, (xx + yy) / 2 as mid, sqrt(((xx - yy) / 2) ** 2 + xy * xy) as root from box),
  every as (select s.image_id, p.v, s.v as sv, half, top, m.y is not null as own from smooth s join px p using (image_id, y, x) join enough using (image_id) left join mask m using (image_id, y, x)),
  own as (select image_id, {sums("own")} from every group by 1), hottest as (select image_id, {sums("sv >= top")} from every group by 1), calm as (select image_id, {sums("sv <= half")} from every group by 1),
  hot as (select o.image_id, {", ".join(f"case when o.n >= 3 then o.{c} else h.{c} end as {c}" for c in "nrgbs")} from own o join hottest h using (image_id)),
  tone as (select image_id, {", ".join(f"hot.{c} / hot.n - calm.{c} / calm.n as {c}" for c in "rgb")}, hot.s / hot.n as spread from hot join calm using (image_id))
  select t.image_id, coalesce(a.n, 0)::bigint as mask_pixels, round(r, 6) as red, round(g, 6) as green, round(b, 6) as blue, round((r + g + b) / 3, 6) as brightness, round(spread, 6) as spread,
    {shape(f"n / {float(side * side)}", "0.0")} as area, {shape("sqrt(greatest(0, 1 - (mid - root) / (mid + root)))", "0.0")} as eccentricity,
    {shape("n / greatest(hull, 1)", "1.0")} as solidity, {shape("n / (tall * wide)::double", "1.0")} as extent, {shape("greatest(tall, wide) / (least(tall, wide) + 1e-6)", "1.0")} as aspect
  from tone t left join axes a using (image_id) left join hull using (image_id)"""
