"""Queries of places: resolved requests, members of regions, indicators by cut, names and labels, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import months, style
from ..operators import entities as N
from ..sources import tables as T
from . import analyses as Q
from .sql import sql


def catalogue(s, d):
    """Parts as municipalities (their size as the state; a name may occur twice in one), regions as states."""
    part, region = T.table(s, d, "part"), T.table(s, d, "region")
    towns = part.select(F.lit("municipality").alias("kind"), F.col("p_partkey").cast("long").alias("code"), F.col("p_size").cast("long").alias("state"), F.concat(F.lit("São "), F.initcap("p_name")).alias("name"))
    return towns.union(region.select(F.lit("state"), F.col("r_regionkey").cast("long"), F.lit(None).cast("long"), F.initcap("r_name")))


def requests(s, d):
    """Orders as requests: by code, by code and name (every fifth by that of the part before), by name within a state, of states, of odd kinds."""
    k = F.col("o_orderkey")
    orders = T.table(s, d, "orders").select(k, (F.col("o_custkey") * 7 % 2200).alias("wanted"))
    part = T.table(s, d, "part")
    at = part.select(F.col("p_partkey").alias("wanted"), F.col("p_size").cast("long").alias("size"), F.upper(F.concat(F.lit("sao - "), "p_name")).alias("own"))
    before = part.select((F.col("p_partkey") + 1).alias("wanted"), F.upper("p_name").alias("other"))
    rows = orders.join(at, "wanted", "left").join(before, "wanted", "left")
    kind = F.when(k % 50 == 0, "country").when(k % 10 == 9, "state").otherwise("municipality")
    code = F.when(k % 10 == 9, k % 7).when(k % 3 > 0, F.col("wanted"))
    name = F.when(k % 10 == 9, F.lit(None)).when(k % 5 == 0, F.col("other")).when(k % 3 != 1, F.col("own"))
    return rows.select(k.alias("request"), kind.alias("kind"), code.cast("long").alias("code"), F.when(k % 3 == 0, F.col("size")).alias("state"), name.alias("name"))


def memberships(s, d):
    """The regions of the territories, and three more that cut across them."""
    towns = T.territories(s, d).where("active and kind = 'municipality'")
    across = towns.select(F.concat(F.lit("S"), (F.col("territory").cast("long") % 3).cast("string")).alias("region"), "territory")
    return towns.where("region is not null").select("region", "territory").union(across)


def states(s, d):
    return T.territories(s, d).where("kind = 'municipality'").select("territory", F.substring("territory", 1, 2).alias("state"))


def cuts(s, d):
    """Purchases by cut; every thirteenth municipality and month hasn't reported."""
    rows = Q.purchases(s, d).groupBy("territory", "month").agg(F.countDistinct("c_custkey").alias("n"), F.sum("cents").alias("cents"))
    told = rows.where((F.col("territory").cast("long") * 7 + months.index(F.col("month"))) % 13 != 0)
    return N.yearly_by_cut(told, memberships(s, d), states(s, d))


def labels(s, d):
    """How the months of orders and their totals are written."""
    o = T.table(s, d, "orders")
    month, price = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("long"), F.col("o_totalprice")
    change = F.col("o_custkey") - F.col("o_orderkey")
    return o.select(
        "o_orderkey", *[style.month_label(month, f).alias(f"{f}_label") for f in ("long", "slash", "short")], style.whole(change, signed=True).alias("change"),
        style.money(price).alias("money"), style.percentage(F.col("o_custkey") / 100.0).alias("percent"),
    )


SHORT = {"small widget": "Widgets", "hot ring": "Rings"}


def names(s, d):
    p = T.table(s, d, "part")
    given = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    return p.select("p_partkey", style.activity_name(given, SHORT).alias("name"), style.folded(F.concat(F.lit("Ação: "), given, F.lit(" Nº ½ – "), "p_brand")).alias("key"))


def month_lists(s, d):
    """Lists of months out of texts: a range, a month, one twice, the last months of the data, months of the years up to a target."""
    given = T.table(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("list"), months.of_list(F.concat(F.lit("199811..1999"), F.lpad((1 + F.col("n_nationkey") % 6).cast("string"), 2, "0"), F.lit(", 199901,200002,200002"))).alias("months"))
    years = given.select("list", months.of_years(F.lit(1998), F.lit(1998) + F.col("list") % 3, F.lit(200005), [3, 6, 12]).alias("months"))
    parts = [("list", given), ("years", years), ("last", given.select("list", months.last(F.lit(200003), F.col("list") % 4 + 1).alias("months")))]
    out = None
    for kind, rows in parts:
        rows = rows.select(F.lit(kind).alias("kind"), "list", F.posexplode("months").alias("place", "month"))
        out = rows if out is None else out.union(rows)
    return out


QUERIES = {
    "entity_resolution": lambda s, d: N.resolve(requests(s, d), catalogue(s, d)),
    "region_members": lambda s, d: N.co_members(memberships(s, d)).withColumn("members", F.array_join("members", ",")),
    "ind_cuts": cuts,
    "ind_relative_complete": lambda s, d: N.relative_to(cuts(s, d), states(s, d)),
    "formatted_labels": labels,
    "activity_names": names,
    "month_lists": month_lists,
}

_MONTHS = "['" + "','".join(style.MONTHS) + "']"
_KEY = "trim(regexp_replace(lower(strip_accents({})), '[^a-z0-9]+', '_', 'g'), '_')"
_GROWTH = "0+sign(1.0e0*(a.{c}-b.{c}))*sign(1.0e0*b.{c})*floor((20000*abs(a.{c}-b.{c})+abs(b.{c}))/nullif(2.0e0*abs(b.{c}),0))/100.0e0"
_CATALOGUE = """select 'municipality' kind, cast(p_partkey as bigint) code, cast(p_size as bigint) state, 'São '||array_to_string(list_transform(string_split(p_name,' '), lambda w: upper(w[1])||lower(w[2:])),' ') as name from part union all select 'state', r_regionkey, null, array_to_string(list_transform(string_split(r_name,' '), lambda w: upper(w[1])||lower(w[2:])),' ') from region"""
_REQUESTS = """select o_orderkey request, case when o_orderkey%50=0 then 'country' when o_orderkey%10=9 then 'state' else 'municipality' end kind, case when o_orderkey%10=9 then o_orderkey%7 when o_orderkey%3>0 then o_custkey*7%2200 end code,
 case when o_orderkey%3=0 then a.p_size end state, case when o_orderkey%10=9 then null when o_orderkey%5=0 then upper(b.p_name) when o_orderkey%3<>1 then upper('sao - '||a.p_name) end as name
 from orders left join part a on a.p_partkey=o_custkey*7%2200 left join part b on b.p_partkey+1=o_custkey*7%2200"""
_CUTS = {
    "mem": "select region, territory from terr where active and kind='municipality' and region is not null union all select 'S'||cast(territory as bigint)%3, territory from terr where active and kind='municipality'",
    "told": "select * from bt where (cast(territory as bigint)*7+month//100*12+month%100-1)%13<>0",
    "summed": """select 'territory' kind, territory cut, month, n, cents from told union all select 'state', left(territory,2), month, cast(sum(n) as bigint), cast(sum(cents) as bigint) from told group by 2,3
 union all select 'region', region, month, cast(sum(n) as bigint), cast(sum(cents) as bigint) from told join mem using (territory) join (select region, count(*) need from mem group by 1) using (region) group by region, month, need having count(*)=need""",
    "cuts_": f"select a.kind, a.cut, a.month, a.n, a.cents, round(a.cents/1e8,1) millions, {_GROWTH.format(c='n')} growth_n, {_GROWTH.format(c='cents')} growth_value from summed a join summed b on b.kind=a.kind and b.cut=a.cut and b.month+100=a.month",
}


def _dots(x: str) -> str:
    return f"replace(format('{{:,}}', cast({x} as bigint)),',','.')"


def _cents(x: str) -> str:
    return f"case when {x}<0 then '−' else '' end||{_dots(f'abs({x})//100')}||','||lpad(cast(abs({x})%100 as varchar),2,'0')"


SQL = {
    "entity_resolution": f"""with cat as (select distinct *, {_KEY.format('name')} k from ({_CATALOGUE})), req as (select *, {_KEY.format('name')} k from ({_REQUESTS})),
 ans as (select request, count(*) n, min(row(code, name, k)) p from (select r.request, c.code, c.name, c.k from req r join cat c on c.kind=r.kind and r.code=c.code union all
 select r.request, c.code, c.name, c.k from req r join cat c on r.code is null and c.kind=r.kind and r.state is not distinct from c.state and r.k=c.k) group by 1),
 st as (select r.request, r.kind, p, case when r.kind not in ('municipality','state') then 'unknown kind' when n is null then 'not found' when n>1 then 'ambiguous' when r.k<>'' and r.k<>p[3] then 'name conflict' else 'matched' end s from req r left join ans using (request))
 select request, case when s='matched' and request<>min(request) over (partition by kind, s, p[1]) then 'duplicate' else s end status, kind, case when s='matched' then p[1] end code, case when s='matched' then p[2] end as name from st""",
    "region_members": sql("select m.territory, m.region, string_agg(o.territory, ',' order by o.territory) members from mem m join mem o using (region) group by 1,2", mem=_CUTS["mem"]),
    "ind_cuts": sql("select * from cuts_", **Q.TOTALS, **_CUTS),
    "ind_relative_complete": sql("select a.cut territory, a.month, round(a.growth_n-b.growth_n,2) points from cuts_ a join cuts_ b on a.kind='territory' and b.kind='state' and b.cut=left(a.cut,2) and b.month=a.month", **Q.TOTALS, **_CUTS),
    "formatted_labels": f"""select o_orderkey, {_MONTHS}[m]||' de '||y long_label, {_MONTHS}[m]||'/'||y slash_label, left({_MONTHS}[m],3)||'/'||right(cast(y as varchar),2) short_label,
 case when c>0 then '+' when c<0 then '−' else '' end||{_dots('abs(c)')} as change, 'R$ '||{_cents('p')} money, {_cents('o_custkey')}||'%' percent
 from (select o_orderkey, cast(o_custkey as bigint) o_custkey, month(o_orderdate) m, year(o_orderdate) y, o_custkey-o_orderkey c, cast(round(o_totalprice*100) as bigint) p from orders)""",
    "activity_names": f"""select p_partkey, case when g='small widget' then 'Widgets' when g='hot ring' then 'Rings' when upper(g)=g then upper(g[1])||lower(g[2:]) else g end as name, {_KEY.format("replace('Ação: '||g||' Nº ½ – '||p_brand, '½', ' ')")} as key
 from (select *, case when p_partkey%2=0 then upper(p_name) else p_name end g from part)""",
    "month_lists": """with l as (select n_nationkey l, 199900+1+n_nationkey%6 hi from nation)
 select 'list' kind, cast(l as bigint) list, cast(row_number() over (partition by l order by k)-1 as int) place, cast(m as bigint) as month from (select l, m, min(k) k from (select l, unnest([199811,199812]||list_transform(range(199901, hi+1), lambda x: x)||[199901,200002,200002]) m, unnest(range(200)) k from l) where m is not null group by 1,2)
 union all select 'years', l, cast(row_number() over (partition by l order by m)-1 as int), m from (select l, y*100+q m from l, range(1998,2001) r(y), (values (3),(6),(12)) v(q) where y<=1998+l%3 and y*100+q<=200005)
 union all select 'last', l, cast(l%4-i as int), ((24002-i)//12)*100+(24002-i)%12+1 from l, range(0,4) t(i) where i<=l%4""",
}
