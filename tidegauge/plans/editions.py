"""Queries of anchors, snapshots, triggers, year-end figures, claims and renderings, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import months
from ..functions.classify import cents
from ..operators import anchor as K
from ..operators import checks as C
from ..operators import editions as E
from ..operators import facts as X
from ..operators import forecast as P
from ..operators import grounding as G
from ..operators import marts as M
from ..sources import editions as store
from ..sources import feeds
from ..sources import tables as T
from ..sources.store import built, shared_dir
from . import analyses as Q
from .marts import KNOWN_UNTIL, levels, movements, report
from .sql import sql

PANEL_MONTHS, PANEL_UNTIL = (200006, 200012, 200106), 200106


def anchors(s, d):
    """The reference stock read as anchors of the end of 1999."""
    rows = M.reference_by_territory(T.reference_stock(s, d), T.territories(s, d))
    return K.anchor_stock(rows.select("territory", "grouping", F.col("reference").cast("string").alias("stock"), F.lit("1999-12-31").alias("reference_date"), F.lit(str(KNOWN_UNTIL)).alias("known_until"), F.lit("reference").alias("source"), F.concat(F.lit("anchors/"), "territory", F.lit(".csv")).alias("file_name")))


def snapshots(s, d):
    panel = anchors(s, d).select("territory", "grouping", F.explode(F.array(*[F.lit(m).cast("long") for m in PANEL_MONTHS])).alias("month"), F.col("stock").alias("panel_stock"), F.lit(PANEL_UNTIL).cast("long").alias("panel_known_until"))
    return K.snapshot_difference(panel, anchors(s, d), M.effects(movements(s, d), T.territories(s, d), "n").withColumn("effect", F.col("effect") * F.col("n")))


def season_of_total(s, d):
    return X.seasonality(Q.total(s, d).withColumn("grouping", F.lit("TOTAL")))


def notable(s, d):
    return X.highlights(X.seasonality(levels(s, d)))


def triggers(s, d):
    high = notable(s, d)
    return E.triggers(Q.total(s, d), season_of_total(s, d), high, X.sector(levels(s, d), Q.flow(s, d)), X.drilldown(Q.flow(s, d), high), X.profile_share(Q.profile(s, d)), X.wage(Q.wages(s, d)))


def figures(s, d):
    rows = Q.series(s, d)
    return E.year_end(rows, P.naive(rows), P.band(P.backtest(rows)))


def revision(s, d):
    rows = Q.series(s, d)
    last = rows.groupBy("territory").agg(F.max("month").alias("last"))
    known = rows.join(F.broadcast(last), "territory").where("month < last").drop("last")
    return E.revision(rows, figures(s, d), P.naive(known))


def before_last(s, d, months_back=1):
    """The series as they were so many months ago."""
    rows = Q.series(s, d)
    last = rows.groupBy("territory").agg(F.max("month").alias("last"))
    return rows.join(F.broadcast(last), "territory").where(F.col("month") <= months.shift(F.col("last"), -months_back)).drop("last")


def combined(rows):
    return P.combined(P.seasonal_rates(rows, 24), P.holt_winters(rows, 24))


def combined_figures(s, d):
    return built(s, d, "fc_kpis_combined", lambda: E.year_end(Q.series(s, d), Q.forecast(s, d), Q.combined_band(s, d)))


def naive_edition(s, d, months_back):
    rows = before_last(s, d, months_back)
    return E.edition_rows(rows, P.naive(rows), P.band(P.backtest(rows)))


def store_of_editions(s, d):
    """A store after three runs: editions of three and two months ago, then that of two months ago again for the states alone, a tenth higher."""
    path = f"{shared_dir(s)}/editions-{uuid.uuid4().hex}"
    for back in (3, 2):
        store.save(naive_edition(s, d, back), path)
    again = naive_edition(s, d, 2).where("length(territory) = 2")
    store.save(again.withColumn("level", F.col("level") * 1.5), path)
    return store.read(s, path)


def stored_revision(s, d):
    """The revision where municipalities of even code (and states) have stored editions and the others haven't."""
    rows, path = Q.series(s, d), f"{shared_dir(s)}/editions-{uuid.uuid4().hex}"
    for back in (4, 2):
        store.save(naive_edition(s, d, back).where("cast(territory as bigint) % 2 = 0"), path)
    return E.revision(rows, figures(s, d), E.previous_editions(rows, store.read(s, path), P.naive(before_last(s, d))))


def combined_revision(s, d):
    """The revision of the combined forecast against an edition stored a month ago for municipalities of even code, else against one recomputed."""
    rows, known, path = Q.series(s, d), before_last(s, d), f"{shared_dir(s)}/editions-{uuid.uuid4().hex}"
    then = built(s, d, "fc_combined_before", lambda: combined(known))
    edition = E.edition_rows(known, then, Q.combined_band(s, d))
    store.save(edition.where("cast(territory as bigint) % 2 = 0"), path)
    return E.revision(rows, combined_figures(s, d), E.previous_editions(rows, store.read(s, path), then))


def claims(s, d):
    total = Q.total(s, d)
    return E.claims(levels(s, d), season_of_total(s, d), X.panorama(total), X.decomposition(total), X.profile_share(Q.profile(s, d)), notable(s, d))


def judged(s, d):
    return claims(s, d).withColumn("p", F.when(F.col("month") % 11 != 0, F.col("month") * 37 % 101 / 100.0))


def fact_values(s, d):
    """id, value, unit of hiring wages, rates and counts."""
    wages, pan = X.wage(Q.wages(s, d)), X.panorama(Q.total(s, d))
    part = lambda rows, c, unit: rows.select(F.concat_ws("/", "territory", "month", F.lit(c)).alias("id"), F.col(c).cast("decimal(24,6)").alias("value"), F.lit(unit).alias("unit"))
    return part(wages, "median_wage", "money").union(part(wages, "mean_wage", "money")).union(part(pan, "rate_month", "percent")).union(part(pan, "stock", "people"))


def registry(s, d):
    """The registry after two loads: all files but those of the last month, then those of the last six months again."""
    rows = movements(s, d).groupBy("feed", "file_month").agg(F.sum("n").alias("rows")).withColumn("load", F.lit(1))
    first = rows.where(F.col("file_month") < T.LAST_MONTH)
    return feeds.upsert(first, rows.where(F.col("file_month") > T.LAST_MONTH - 6).withColumn("load", F.lit(2)), "feed", "file_month")


QUERIES = {
    "anchor_stock": lambda s, d: anchors(s, d).withColumn("reference_date", F.col("reference_date").cast("string")),
    "ingestion_registry": registry,
    "dq_grain_registry": lambda s, d: C.repeated(registry(s, d), "feed", "file_month"),
    "dq_snapshot_rebuild": snapshots,
    "dq_anchor_complete": lambda s, d: K.incomplete(anchors(s, d)),
    "dq_territory_without_anchor": lambda s, d: T.territories(s, d).where("active").join(anchors(s, d), "territory", "left_anti").select("territory"),
    "pair_validation": lambda s, d: K.pair_validation(report(s, d)),
    "reference_change": lambda s, d: K.content_change(T.table(s, d, "events").select(F.col("user_id").alias("source"), F.col("ts").alias("at"), F.col("event_id").alias("entry"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("content"))),
    "fact_triggers": triggers,
    "fc_kpis": figures,
    "fc_reading": lambda s, d: E.reading(figures(s, d)),
    "fc_revision": revision,
    "edition_store": store_of_editions,
    "fc_revision_stored": stored_revision,
    "fc_kpis_combined": combined_figures,
    "fc_reading_combined": lambda s, d: E.reading(combined_figures(s, d)),
    "fc_revision_combined": combined_revision,
    "labelled_claims": lambda s, d: claims(s, d).withColumn("ids", F.concat_ws(",", "ids")),
    "hits_by_family": lambda s, d: E.hits_by_family(judged(s, d)),
    "cited_ids_missing": lambda s, d: E.unknown_ids(claims(s, d), X.registry(Q.total(s, d))),
    "ind_trajectory": lambda s, d: E.trajectory(Q.yearly(s, d)),
    "ind_conditional_rate": lambda s, d: E.conditional_rate(T.table(s, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("value")), notable(s, d)),
    "allowed_numbers": lambda s, d: G.renderings(fact_values(s, d)),
    "table_only_numbers": lambda s, d: E.table_only(G.numbers(T.table(s, d, "documents")), Q.text_facts(s, d), T.table(s, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("value"))).select("doc_id", "place", "token"),
    "thousands_format": lambda s, d: T.table(s, d, "orders").select("o_orderkey", E.thousands(F.concat(F.lit("R$ "), cents(F.col("o_totalprice")), F.lit(" em 1998 por "), "o_orderkey", F.lit(" itens"))).alias("text")),
}

_f = lambda q, **more: sql(q, **Q.TOTALS, **more)
_of = lambda name: f"({Q.SQL[name]})"
_PCT = "0+sign(1.0e0*({a}))*sign(1.0e0*({b}))*floor((20000*abs({a})+abs({b}))/nullif(2.0e0*abs({b}),0))/100.0e0"
_ANCHORS = """select territory, "grouping", reference stock, date '1999-12-31' reference_date, cast(199912 as bigint) anchor_month, cast(200006 as bigint) known_until, 'reference' source, territory||'.csv' file_name from ref"""
_TS = """select *, case when years<3 then 'insufficient' when net>high then 'above' when net<low then 'below' else 'inside' end position from (select territory, month, net, min(net) over w low, max(net) over w high, count(net) over w as years from tot window w as (partition by territory, month%100 order by month rows between unbounded preceding and 1 preceding))"""
_AT = "(select territory, month//100 as yr, f.level lv, f.level+low lo, f.level+high hi from {naive} f left join {band} b using (territory, h) where month%100=12)"
_KPI = f"""select e.territory, e.yr as year, a.lv level_end, a.lo level_end_low, a.hi level_end_high, n.lv level_next, n.lo level_next_low, n.hi level_next_high, a.lv-b.level net_year, a.lo-b.level net_year_low, a.hi-b.level net_year_high
 from (select territory, last//100+case when last%100=12 then 1 else 0 end yr from ends_) e left join {_AT.format(naive=_of("fc_naive"), band=_of("fc_band"))} a on a.territory=e.territory and a.yr=e.yr
 left join {_AT.format(naive=_of("fc_naive"), band=_of("fc_band"))} n on n.territory=e.territory and n.yr=e.yr+1 left join back b on b.territory=e.territory and b.month=(e.yr-1)*100+12"""
_CLAIMS = f"""with t0 as ({_f(_TS)}), n0 as {_of("fact_highlights")}, l0 as ({_f("select * from level")}), p0 as {_of("fact_panorama")}, d0 as {_of("fact_decomposition")}, w0 as {_of("fact_profile")},
 c0 as (select a.*, b.rate_month rs from p0 a join p0 b on length(a.territory)>2 and b.territory=left(a.territory,2) and b.month=a.month and a.rate_month<>b.rate_month)
 select territory, month, family, claim, list_transform(m, lambda x: territory||'/'||month||'/'||x) ids, truth from (
 select territory, month, 'sign' family, 'net positive: '||"grouping" claim, ['net'] m, net>0 truth from l0 where net<>0 and "grouping"<>'Não Identificado'
 union all select territory, month, 'sign', 'net negative: '||"grouping", ['net'], net<0 from l0 where net<>0 and "grouping"<>'Não Identificado'
 union all select territory, month, 'band', 'net '||p||' its band', ['net'], position=p from t0, (values ('below'),('inside'),('above')) v(p) where position<>'insufficient'
 union all select territory, month, 'comparison', 'level grew more than the state''s', ['rate_month','state_rate_month'], rate_month>rs from c0 union all select territory, month, 'comparison', 'level grew less than the state''s', ['rate_month','state_rate_month'], rate_month<rs from c0
 union all select territory, month, 'direction by '||f, 'admissions '||w||' over the year', m, case when w='fell' then from_admissions<0 else from_admissions>0 end from d0, (values ('change',['admissions_change']),('levels',['admissions','admissions_year_ago'])) v(f,m), (values ('fell'),('rose')) z(w) where from_admissions<>0
 union all select territory, month, 'profile', 'women''s share of admissions rose', ['share_women'], change>0 from w0 where category='Mulher' and change<>0
 union all select territory, month, 'cause', 'interest rates moved '||"grouping", ['net'], false from n0 where rank=1)"""
_VALUES = f"""select territory||'/'||month||'/median_wage' id, cast(median_wage as decimal(24,6)) v, 'money' unit from {_of("fact_wage")} union all select territory||'/'||month||'/mean_wage', cast(mean_wage as decimal(24,6)), 'money' from {_of("fact_wage")}
 union all select territory||'/'||month||'/rate_month', cast(rate_month as decimal(24,6)), 'percent' from {_of("fact_panorama")} union all select territory||'/'||month||'/stock', cast(stock as decimal(24,6)), 'people' from {_of("fact_panorama")}"""



def _edition(back: int) -> str:
    """The naive edition made so many months ago, with its band."""
    i = "({0}//100*12+{0}%100-1)".format
    rel = {
        "kn": f"select b.* from back b join ends_ e using (territory) where {i('b.month')}<={i('e.last')}-{back}",
        "en": "select territory, max(month) last, max_by(level, month) anchor from kn group by 1",
        "ah": f"select en.*, h, (({i('last')}+h)//12)*100+({i('last')}+h)%12+1 as month from en, (select cast(unnest(range(1,25)) as bigint) h) x",
        "nv": "select a.territory, a.h, a.last edition, a.month, b.admissions, b.separations, anchor+sum(b.admissions-b.separations) over (partition by a.territory order by a.h) lv from ah a join kn b on b.territory=a.territory and b.month=a.month-100*((a.h+11)//12)",
        "cm": f"select territory, {i('month')} t, level, sum(net) over (partition by territory order by month) c, row_number() over (partition by territory order by month) i from kn",
        "er": "select o.territory, h, r.level-o.level-e.c+y.c error from cm o, (select unnest(range(1,13)) h) x, cm e, cm y, cm r where o.i>24 and e.territory=o.territory and y.territory=o.territory and r.territory=o.territory and e.t=o.t+h-12 and y.t=o.t-12 and r.t=o.t+h",
        "bq": "select territory, h, quantile_cont(cast(error as double),0.1) lo, quantile_cont(cast(error as double),0.9) hi from er group by 1,2 having count(*)>=8",
        "bk": "select territory, max(h) k, max_by(lo,h) lo, max_by(hi,h) hi from bq group by 1",
        "bd": "select territory, h, round(min(lo) over w,4) low, round(max(hi) over w,4) high from (select bk.territory, x.h, coalesce(q.lo, bk.lo*sqrt(1.0e0*x.h/bk.k)) lo, coalesce(q.hi, bk.hi*sqrt(1.0e0*x.h/bk.k)) hi from bk cross join (select cast(unnest(range(1,25)) as bigint) h) x left join bq q on q.territory=bk.territory and q.h=x.h) z window w as (partition by territory order by h)",
    }
    inner = ", ".join(f"{n} as ({q})" for n, q in rel.items())
    return f"select * from (with {inner} select nv.territory, edition, nv.month, cast(admissions as double) admissions, cast(separations as double) separations, cast(admissions-separations as double) net, cast(lv as double) as level, cast(lv+low as double) low, cast(lv+high as double) high from nv left join bd using (territory, h) /* from back, ends_ */)"


SQL = {
    "anchor_stock": _f(_ANCHORS.replace("date '1999-12-31'", "'1999-12-31'")),
    "ingestion_registry": _f("select feed, file_month, count(*) as rows, case when file_month>200105 then 2 else 1 end as load from ev group by 1,2"),
    "dq_grain_registry": _f("select feed, file_month, count(*) n from (select feed, file_month, count(*) from ev where file_month<=200105 group by 1,2 union all select feed, file_month, count(*) from ev where file_month>200105 group by 1,2) group by 1,2 having count(*)>1"),
    "dq_snapshot_rebuild": _f("""select *, rebuilt-panel_stock difference from (select p.territory, p."grouping", p.pm as month, p.reference panel_stock, cast(p.reference+coalesce(sum(e.effect) filter (e.file_month<=200106 and ((e.month>199912 and e.month<=p.pm) or (e.feed<>'MOV' and e.month<=199912 and e.file_month>200006))),0) as bigint) rebuilt
 from (select ref.*, cast(m as bigint) pm from ref, (values (200006),(200012),(200106)) v(m)) p left join fan e on e.territory=p.territory and e."grouping"=p."grouping" group by 1,2,3,4) where rebuilt<>panel_stock"""),
    "dq_anchor_complete": _f('select territory, count(*) as rows, count(distinct "grouping") groupings, count(distinct 1) dates, count(distinct 1) cuts from ref group by 1 having count(*)<>6 or count(distinct "grouping")<>6'),
    "dq_territory_without_anchor": _f("select territory from terr where active and territory not in (select territory from ref)"),
    "pair_validation": _f("""select *, totals=1 and repeated=0 and incoherent=0 and admissions_gap=0 and separations_gap=0 and net_gap=0 as valid, stock_missing>0 or stock_sum is distinct from stock_total as observe from (
 select month, count(*) filter (t) totals, count(*) filter (not t) "groups", count(*) filter (not t)-count(distinct "grouping") filter (not t) repeated, count(*) filter (admissions-separations<>net) incoherent,
 cast(sum(case when t then -admissions else admissions end) as bigint) admissions_gap, cast(sum(case when t then -separations else separations end) as bigint) separations_gap, cast(sum(case when t then -net else net end) as bigint) net_gap,
 count(*) filter (not t and stock is null) stock_missing, cast(coalesce(sum(stock) filter (not t),0) as bigint) stock_sum, max(stock) filter (t) stock_total from (select *, "grouping"='TOTAL' t from report) group by 1)"""),
    "reference_change": """select source, entry, case when content is null then 'unavailable' when before is null then 'loaded' when before=content then 'same' else 'changed' end state from (select *, last_value(content ignore nulls) over (partition by source order by ts, entry rows between unbounded preceding and 1 preceding) as before from (
 select user_id source, ts, event_id entry, case when event_type<>'error' then event_type end as content from events))""",
    "fact_triggers": f"""select territory, month, 'provisional' kind, cast(null as varchar) detail from ({_f("select territory, month, (max(month) over (partition by territory)//100*12+max(month) over (partition by territory)%100)-(month//100*12+month%100) age from tot")}) where age<12
 union all select territory, month, 'seasonal total', position from ({_f(_TS)}) where position in ('above','below') union all select territory, month, 'seasonal grouping', "grouping"||':'||position from {_of("fact_highlights")} where position in ('above','below')
 union all select territory, month, 'concentration', "grouping" from {_of("fact_sector")} where share_of_movement>=60 and abs(net)>=3 and "grouping"<>'Não Identificado' union all select territory, month, 'dominant activity', "grouping"||':'||code from {_of("fact_drilldown")}
 union all select territory, month, 'small base profile', dimension||':'||category from {_of("fact_profile")} where small_base union all select territory, month, 'small base wage', null from {_of("fact_wage")} where small_base
 union all select territory, month, 'total near zero', null from ({_f("select * from tot")}) where abs(net)<5""",
    "fc_kpis": _f(_KPI),
    "fc_reading": f"select territory, year, case when net_year_low>0 then 'growth' when net_year_high<0 then 'contraction' when net_year_low is not null then 'stability' end reading from ({_f(_KPI)})",
    "fc_revision": f"""with k as ({_f(_KPI)}), b0 as ({_f("select * from back")}), now_ as (select territory, max(month) as month, max_by(level, month) realised from b0 group by 1),
 kn as (select b0.* from b0 join now_ using (territory) where b0.month<now_.month), e0 as (select territory, max(month) lastm, max_by(level, month) anchor from kn group by 1),
 ah as (select e0.*, h, ((lastm//100*12+lastm%100-1+h)//12)*100+(lastm//100*12+lastm%100-1+h)%12+1 as month from e0, (select cast(unnest(range(1,25)) as bigint) h) x),
 pv as (select a.territory, a.month, cast(anchor+sum(b.admissions-b.separations) over (partition by a.territory order by a.h) as bigint) lv from ah a join kn b on b.territory=a.territory and b.month=a.month-100*((a.h+11)//12))
 select n.territory, 'recomputed' origin, n.month, p.lv said_of_month, n.realised, q.lv said_of_end, k.level_end, abs(k.level_end-q.lv)>k.level_end_high-k.level_end_low beyond_band
 from now_ n left join k using (territory) left join pv p on p.territory=n.territory and p.month=n.month left join pv q on q.territory=n.territory and q.month=k.year*100+12""",
    "edition_store": _f(" union all ".join(_edition(k) + f" where not {cond}" if cond else _edition(k) for k, cond in ((3, ""), (2, "length(territory)=2"))) + " union all select territory, edition, month, admissions, separations, net, level*1.5e0, low, high from (" + _edition(2) + ") where length(territory)=2"),
    "fc_revision_stored": f"""with k as ({_f(_KPI)}), b0 as ({_f("select * from back")}), now_ as (select territory, max(month) as month, max_by(level, month) realised from b0 group by 1),
 pv as (select territory, month, level, 'stored' origin from ({_f(_edition(2))}) where cast(territory as bigint)%2=0 union all select territory, month, level, 'recomputed' from ({_f(_edition(1))}) where cast(territory as bigint)%2=1)
 select n.territory, o.origin, n.month, p.level said_of_month, n.realised, q.level said_of_end, k.level_end, abs(k.level_end-q.level)>k.level_end_high-k.level_end_low beyond_band
 from now_ n left join k using (territory) left join (select distinct territory, origin from pv) o on o.territory=n.territory left join pv p on p.territory=n.territory and p.month=n.month left join pv q on q.territory=n.territory and q.month=k.year*100+12""",
    "labelled_claims": f"select territory, month, family, claim, array_to_string(ids, ',') ids, truth from ({_CLAIMS})",
    "hits_by_family": f"select family, count(*) cases, count(*) filter ((case when month%11<>0 then month*37%101/100.0e0 else 0 end>=0.6e0)=truth) hits from ({_CLAIMS}) group by 1",
    "cited_ids_missing": f"select family, id, count(*) n from (select family, unnest(ids) id from ({_CLAIMS})) where id not in (select id from {_of('fact_registry')}) group by 1,2",
    "ind_trajectory": _f("""select territory, month, other, case when step<0 then 'earlier' else 'later' end side, growth_n, growth_value from (select *, count(*) over (partition by territory, month, step>0 order by step) upto from (
 select a.territory, a.month, b.month other, (b.month//100*12+b.month%100)-(a.month//100*12+a.month%100) step, b.growth_n, b.growth_value from yt a join yt b on b.territory=a.territory and b.month<>a.month and abs((b.month//100*12+b.month%100)-(a.month//100*12+a.month%100))<=3)) where step<0 or upto=step"""),
    "ind_conditional_rate": _f("""select h.territory, h.month, min_by(v, dy) year_before, max_by(v, dy) month_end from (select distinct territory, month from notable where "grouping" in ('Construção','Comércio')) h
 join (select cast(o_orderdate as date) dy, count(*) v from orders group by 1) o on (year(dy)*100+month(dy)) between h.month-100 and h.month group by 1,2"""),
    "allowed_numbers": f"""select distinct id, cast(u.value as double) as value, u.thousands from (select id, unnest(case when unit='percent' then [{{'value': cast(round(a,0) as decimal(24,6)), 'thousands': false}}, {{'value': cast(round(a,1) as decimal(24,6)), 'thousands': false}}, {{'value': cast(round(a,2) as decimal(24,6)), 'thousands': false}}]
 when unit='money' then [{{'value': cast(round(a,2) as decimal(24,6)), 'thousands': false}}, {{'value': cast(round(a,0) as decimal(24,6)), 'thousands': false}}]
 else [{{'value': a, 'thousands': false}}, {{'value': cast(round(cast(a*0.001 as decimal(30,9)),1) as decimal(24,6)), 'thousands': true}}, {{'value': cast(round(cast(a*0.001 as decimal(30,9)),0) as decimal(24,6)), 'thousands': true}}] end) u from (select id, abs(v) a, unit from ({_VALUES}) where v is not null))""",
    "table_only_numbers": sql("""select doc_id, place, token from num where (mil or not (v=floor(v) and (v between 1 and 12 or v between 2019 and 2035))) and exists (select 1 from said where said.v=num.v and said.mil=num.mil)
 and not exists (select 1 from kept where kept.v=num.v and kept.mil=num.mil)""", **Q.TOTALS, open_="select cast(o_orderkey as double) v from orders where o_orderstatus='O'", kept=Q.TOTALS["said"].replace("facts", "open_")),
    "thousands_format": """select o_orderkey, 'R$ '||replace(format('{:,}', cast(round(o_totalprice*100) as bigint)),',','.')||' em 1998 por '||case when o_orderkey between 1990 and 2100 then cast(o_orderkey as varchar) else replace(format('{:,}', o_orderkey),',','.') end||' itens' as text from orders""",
}
