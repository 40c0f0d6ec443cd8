"""Queries of what is published: the registry of all facts, hashes of editions, tables, and bulletins held against their facts, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import style
from ..functions.classify import AGE_BANDS
from ..operators import facts as X
from ..operators import grounding as G
from ..operators import published as W
from ..sources.store import built
from . import analyses as Q
from . import editions as QE
from . import places as N
from .marts import flow, levels, profile, region, wages
from .sql import sql

#: What running text may say, and what stays in tables.
TEXT_RULES = [("panorama", ("net", "rate_month")), ("wage", ())]
LABELS = [label for _, label in AGE_BANDS] + ["65 ou mais"]


def families(s, d):
    total, high = Q.total(s, d), QE.notable(s, d)
    return {
        "panorama": X.panorama(total), "decomposition": X.decomposition(total), "accumulated": X.accumulated(total), "sector": X.sector(levels(s, d), flow(s, d)), "highlights": high,
        "drilldown": X.drilldown(flow(s, d), high), "comparison": X.comparison(levels(s, d), region(s, d)).withColumnRenamed("place", "territory"), "profile": X.profile_share(profile(s, d)), "wage": X.wage(wages(s, d)),
    }


def registry(s, d):
    return built(s, d, "fact_registry", lambda: W.unique(W.registry(families(s, d)), "territory", "month", "id"))


def hashes(s, d):
    """The hash of each edition's facts, out of rows in no order."""
    return W.content_hash(registry(s, d).select("territory", "month", "id", "value", "unit").repartition("id"), ["territory", "month"])


def bulletins(s, d):
    """A short text of each territory and month; months that 5 divides say one too many, those that 7 divides another rate."""
    pan, wage = X.panorama(Q.total(s, d)), X.wage(wages(s, d)).select("territory", "month", "median_wage")
    rows = pan.join(wage, ["territory", "month"], "left")
    said = lambda c: F.coalesce(c, F.lit("sem dado"))
    net = F.col("net") + F.when(F.col("month") % 5 == 0, 1).otherwise(0)
    rate = F.col("rate_month") + F.when(F.col("month") % 7 == 0, 0.01).otherwise(0.0)
    text = F.concat(
        F.lit("Saldo de "), style.whole(net), F.lit(" vínculos (taxa: "), said(style.percentage(rate)), F.lit("). Estoque de "), said(style.whole(F.col("stock"))),
        F.lit(", cerca de "), said(style.decimals(F.col("stock") / 1000, 1)), F.lit(" mil. Mediana de "), said(style.money(F.col("median_wage"))),
        F.lit("; jovens de 18 a 24 anos e pessoas de 65 ou mais: "), style.whole(F.col("admissions") * 3 + 14), F.lit(". Em 2024, F19 e 9 casos."),
    )
    return rows.select("territory", "month", text.alias("text"))


def tokens(s, d):
    return G.numbers(bulletins(s, d), LABELS, ("territory", "month"))


SCOPE = ("territory", "month")

QUERIES = {
    "fact_registry_full": lambda s, d: registry(s, d).withColumn("value", F.col("value").cast("double")),
    "fact_hash": hashes,
    "fact_table_groupings": lambda s, d: W.grouping_table(X.sector(levels(s, d), flow(s, d))),
    "fact_table_regional": lambda s, d: W.regional_table(X.comparison(levels(s, d), region(s, d)), N.memberships(s, d), N.states(s, d)),
    "fact_table_profile": lambda s, d: W.profile_table(X.profile_share(profile(s, d))),
    "bulletin_numbers": tokens,
    "bulletin_ungrounded": lambda s, d: G.ungrounded(tokens(s, d), registry(s, d), *SCOPE).select(*SCOPE, "place", "token"),
    "bulletin_table_only": lambda s, d: G.only_in_tables(tokens(s, d), registry(s, d), TEXT_RULES, *SCOPE).select(*SCOPE, "place", "token"),
}


def _facts(family: str) -> str:
    parts, units = W.FAMILIES[family]
    query = {"panorama": "fact_panorama", "decomposition": "fact_decomposition", "accumulated": "fact_accumulated", "sector": "fact_sector", "highlights": "fact_highlights", "drilldown": "fact_drilldown", "comparison": "fact_comparison", "profile": "fact_profile", "wage": "fact_wage"}[family]
    place = "place" if family == "comparison" else "territory"
    fold = "".join(f"||'.'||{N._KEY.format(f'{chr(34)}{p}{chr(34)}')}" for p in parts)
    about = ", ".join(f'"{p}"' for p in parts)
    told = f"concat_ws(', ', '{family}'{', ' + about if about else ''})"
    one = lambda c, u: f"select {place} territory, month, '{family}'{fold}||'.{c}' id, cast({c} as decimal(24,2)) as value, '{u}' unit, '{c.replace('_', ' ')} of '||{told} description from x where {c} is not null"
    return f"(with x as ({Q.SQL[query]}) " + " union all ".join(one(c, u) for c, u in units.items()) + ")"


_REGISTRY = " union all ".join(f"select * from {_facts(f)}" for f in W.FAMILIES)
_D = N._dots
_PCT = "case when {x}<0 then '−' else '' end||"
_HUNDREDTHS = lambda x: N._cents(f"cast(round(cast({x} as decimal(24,6))*100,0) as bigint)")
_WHOLE = lambda x: f"case when {x}<0 then '−' else '' end||{_D(f'abs({x})')}"
_TENTHS = "case when stock<0 and t10<>0 then '−' else '' end||" + _D("abs(t10)//10") + "||','||abs(t10)%10"
_TEXT = f"""select territory, month, 'Saldo de '||{_WHOLE('said')}||' vínculos (taxa: '||coalesce({_HUNDREDTHS('rate')}||'%','sem dado')||'). Estoque de '||coalesce({_WHOLE('stock')},'sem dado')||', cerca de '||coalesce({_TENTHS},'sem dado')||' mil. Mediana de '||coalesce('R$ '||{_HUNDREDTHS('median_wage')},'sem dado')
 ||'; jovens de 18 a 24 anos e pessoas de 65 ou mais: '||{_WHOLE('people')}||'. Em 2024, F19 e 9 casos.' as text from (select *, net+case when month%5=0 then 1 else 0 end said, rate_month+case when month%7=0 then 0.01e0 else 0 end rate, admissions*3+14 people, cast(round(cast(stock/1000.0e0 as decimal(24,6))*10,0) as bigint) t10
 from ({Q.SQL['fact_panorama']}) left join (select territory, month, median_wage from ({Q.SQL['fact_wage']})) using (territory, month))"""
_MASKED = "replace(replace(text, '18 a 24 anos', 'jovens_'), '65 ou mais', 'idosos_')"  # where these texts have labels
_RUNS = f"""select territory, month, i, r[i] run, g[i] before, g[i+1] as after, r[i+1] nxt, string_split(r[i],'.') f from (select territory, month, regexp_extract_all({_MASKED}, '[\\pL\\pN_.,]+') r, string_split_regex({_MASKED}, '[\\pL\\pN_.,]+') g from ({_TEXT})), unnest(range(1, len(r)+1)) t(i)"""
_NUM = f"""select territory, month, cast(row_number() over (partition by territory, month order by i)-1 as int) place, token, try_cast(replace(replace(replace(token,'.',''),',','.'),'−','-') as double) as value, mil as thousands from (
 select territory, month, i, case when right(before,1) in ('-','−') and (i=1 or length(before)>1) then right(before,1) else '' end||body||decimals token, rest='' and regexp_full_match(after,'[[:space:]]+') and coalesce(regexp_replace(lower(nxt),'[.,].*$','')='mil',false) mil from ({Q._figures(_RUNS)}))"""
_SAID = """select territory, month, id, unnest(case when unit in ('percent','points') then [{'v': round(a,0), 'm': false}, {'v': round(a,1), 'm': false}, {'v': a, 'm': false}] when unit='money' then [{'v': a, 'm': false}, {'v': round(a,0), 'm': false}]
 else [{'v': a, 'm': false}, {'v': round(cast(a*0.001 as decimal(30,9)),1), 'm': true}, {'v': round(cast(a*0.001 as decimal(30,9)),0), 'm': true}] end) w from (select *, cast(abs(value) as decimal(24,2)) a from reg)"""
_WAYS = "select territory, month, id, cast(w.v as double) v, w.m m from said_ union all select territory, month, id, cast(w.v as double)/1000, true from said_ where not w.m"
_FREE = "(v=floor(v) and (v between 1 and 12 or v between 2019 and 2035))"
_WITH = f"with num_ as (select *, abs(value) v from ({_NUM})), reg as ({_REGISTRY}), said_ as ({_SAID}), ways as ({_WAYS})"
_KNOWN = "exists (select 1 from ways w where w.territory=num_.territory and w.month=num_.month and w.v=num_.v and w.m=num_.thousands{})"
_TABLE = """select territory, month, cast(row_number() over (partition by territory, month order by "grouping"='TOTAL', "grouping"='Não Identificado', "grouping") as int) place, * exclude (territory, month) from (
 select territory, month, "grouping", net, stock, share_of_stock from x union all select territory, month, 'TOTAL', cast(sum(net) as bigint), case when count(stock)=count(*) then cast(sum(stock) as bigint) end, null from x group by 1,2)"""

SQL = {
    "fact_registry_full": f"select * replace (cast(value as double) as value) from ({_REGISTRY})",
    "fact_hash": f"select territory, month, count(*) facts, sha256(string_agg(line, '' order by line)) hash from (select territory, month, sha256('id='||id||'|unit='||unit||'|value='||cast(value as varchar)) line from ({_REGISTRY})) group by 1,2",
    "fact_table_groupings": f"with x as ({Q.SQL['fact_sector']}) {_TABLE}",
    "fact_table_regional": sql(
        "select territory, month, cast(row_number() over (partition by territory, month order by k, name) as int) place, kind, name, net, stock, rate_month, rate_year from line_ join cmp on cmp.place=line_.name",
        mem=N._CUTS["mem"], line_="select territory, 0 k, 'territory' kind, territory as name from terr where kind='municipality' union all select territory, 1, 'region', region from mem union all select territory, 2, 'state', left(territory,2) from terr where kind='municipality'", cmp=f"select * from ({Q.SQL['fact_comparison']})",
    ),
    "fact_table_profile": f"select territory, month, dimension, cast(row_number() over (partition by territory, month, dimension order by category='Não Identificado', category) as int) place, category, admissions, share, share_year_ago, change from ({Q.SQL['fact_profile']})",
    "bulletin_numbers": _NUM,
    "bulletin_ungrounded": f"{_WITH} select territory, month, place, token from num_ where (thousands or not {_FREE}) and not {_KNOWN.format('')}",
    "bulletin_table_only": f"{_WITH} select territory, month, place, token from num_ where not {_FREE} and {_KNOWN.format('')} and not "
    + _KNOWN.format(" and (split_part(w.id,'.',1)='panorama' and split_part(w.id,'.',-1) in ('net','rate_month') or split_part(w.id,'.',1)='wage')"),
}
