"""Queries of checks, facts, forecasts, text, calibration, audits and windows, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import months
from ..functions.classify import cents, check_digit
from ..operators import checks as C
from ..operators import facts as X
from ..operators import forecast as P
from ..operators import grounding as G
from ..operators import marts as M
from ..operators import text_and_audit as A
from ..sources import tables as T
from ..sources.store import built
from .marts import adjustment, events, flagship, flow, levels, monthly, movements, profile, reconciled, region, report, wages
from .sql import sql

GRAIN = ["territory", "grouping", "month"]


def ev(s, d):
    return events(s, d)


def total(s, d):
    return built(s, d, "totals", lambda: X.totals(flow(s, d), levels(s, d)))


def series(s, d):
    return built(s, d, "fc_series", lambda: P.backcast(P.series(total(s, d))))


def method_errors(s, d):
    rows = series(s, d)
    smooth = built(s, d, "fc_smooth_origins", lambda: P.holt_winters(rows, 24, first_origin=24))
    return built(s, d, "fc_errors", lambda: P.backtest_methods(rows, 24, 24, smooth))


def forecast(s, d):
    rows = series(s, d)
    return built(s, d, "fc_combined", lambda: P.combined(P.seasonal_rates(rows, 24), P.holt_winters(rows, 24)))


def combined_band(s, d):
    return P.band(method_errors(s, d).where("method = 'combined'"))


def guards(s, d):
    from .editions import combined_revision

    anchors = series(s, d).groupBy("territory").agg(F.max_by("level", "month").alias("anchor"))
    return P.guards(forecast(s, d), combined_band(s, d), anchors, P.mae_methods(method_errors(s, d)), combined_revision(s, d))


def scored(s, d):
    rows = T.table(s, d, "labels")
    return rows.select((F.col("quality") == 1).alias("truth"), (F.col("doc_id") * 37 % 101 / 100.0).alias("p"))


def entries(s, d):
    kind = F.when(F.col("event_type") == "signup", "reserve").when(F.col("event_type") == "purchase", "call").when(F.col("event_type") == "error", "close")
    return T.table(s, d, "events").select(F.col("user_id").alias("run"), kind.alias("kind"), F.col("ts").alias("at"), F.col("event_id").alias("entry"), cents(F.col("value")).alias("cents")).where("kind is not null")


def official(s, d) -> DataFrame:
    """The reconciled nets with known differences: one more in months 7 divides, none in those 11 divides, null where 13 does."""
    rows = reconciled(s, d).where("month % 11 <> 0")
    return rows.select("month", "grouping", F.when(F.col("month") % 13 != 0, F.col("net") + F.when(F.col("month") % 7 == 0, 1).otherwise(0)).alias("net"))


def purchases(s, d):
    o = T.table(s, d, "orders").join(T.table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    n = F.broadcast(T.table(s, d, "nation"))
    rows = o.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select((10 + F.col("n_regionkey")).alias("state"), ((10 + F.col("n_regionkey")) * 10000 + F.col("n_nationkey")).cast("string").alias("territory"), (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("long").alias("month"), "c_custkey", cents(F.col("o_totalprice")).alias("cents"))
    return rows


def yearly(s, d, key="territory"):
    rows = purchases(s, d).withColumn("territory", F.col(key).cast("string"))
    return A.yearly_growth(rows.groupBy("territory", "month").agg(F.countDistinct("c_custkey").alias("n"), F.sum("cents").alias("cents")))


def relative(s, d):
    """A municipality's growth less its state's, in points."""
    state = yearly(s, d, "state").select(F.col("territory").alias("state"), "month", F.col("growth_n").alias("growth_state"))
    own = yearly(s, d).withColumn("state", F.substring("territory", 1, 2))
    return own.join(state, ["state", "month"]).select("territory", "month", F.round(F.col("growth_n") - F.col("growth_state"), 2).alias("points"))


def generic(s, d):
    e = ev(s, d)
    return C.generic(e, {"sign": F.col("sign").isin(1, -1), "wage_unit": F.col("wage_unit").isin(1, 2, 3, 4, 5, 6, 7, 99), "sex_known": F.col("sex").isNotNull(), "age_known": F.col("age").isNotNull(), "section": F.col("section") != "Z"})


#: Checks whose findings are told, not barred.
WARNED = {"dq_unidentified_negative", "dq_month_continuity", "dq_late_files_continuity", "dq_wage_range", "dq_mean_vs_median", "dq_individual_wage", "dq_territory_without_reference", "dq_anchor_adjustment", "dq_volume_anomaly", "dq_freshness", "dq_exclusion_sign"}
UNCOUNTED = {"dq_generic", "dq_summary"}


def checks() -> list[str]:
    return [n for n in QUERIES if n.startswith("dq_") and n not in UNCOUNTED]


def dq_summary(s, d):
    """check, severity, violations, status of every check."""
    return C.summary({n: (C.SEVERITY_WARN if n in WARNED else C.SEVERITY_ERROR, QUERIES[n](s, d)) for n in checks()})


def text_facts(s, d):
    return T.table(s, d, "orders").select(F.col("o_orderkey").alias("value"))


QUERIES = {
    "dq_stock_coherent": lambda s, d: C.stock_coherent(levels(s, d)),
    "dq_reconciled_coherent": lambda s, d: C.same_net(reconciled(s, d).select("month", "grouping", F.col("net_mov").alias("net")), monthly(s, d), ["month", "grouping"], ["net"]),
    "dq_net_coherent": lambda s, d: monthly(s, d).where("net <> admissions - separations").select("month", "grouping", "net"),
    "dq_late_files_continuity": lambda s, d: C.missing_months(movements(s, d).where("feed <> 'MOV'").select("feed", "file_month"), "feed", "file_month"),
    "dq_month_continuity": lambda s, d: C.missing_months(movements(s, d).where("feed = 'MOV'").select("municipality", "month"), "municipality", "month"),
    "dq_stock_matches_reference": lambda s, d: C.stock_matches_reference(levels(s, d), M.reference_by_territory(T.reference_stock(s, d), T.territories(s, d)), T.REFERENCE_MONTH),
    "dq_unidentified_negative": lambda s, d: C.negative(levels(s, d), True),
    "dq_stock_non_negative": lambda s, d: C.negative(levels(s, d), False),
    "dq_region_sum": lambda s, d: C.same_net(region(s, d).where("net is not null"), levels(s, d).join(F.broadcast(T.territories(s, d).where("active and region is not null").select("region", "territory")), "territory"), ["region", "grouping", "month"], ["net"]),
    "dq_exclusion_sign": lambda s, d: C.exclusion_sign(ev(s, d)),
    "dq_wage_range": lambda s, d: C.wage_range(wages(s, d)),
    "dq_flow_matches_stock": lambda s, d: C.same_net(flow(s, d), levels(s, d), GRAIN, ["net"]),
    "dq_flow_matches_reconciled": lambda s, d: C.same_net(flow(s, d).join(F.broadcast(flagship(s, d).select(F.col("municipality").cast("string").alias("territory"))), "territory"), reconciled(s, d), ["month", "grouping"], ["admissions", "separations"]),
    "dq_mean_vs_median": lambda s, d: C.mean_vs_median(monthly(s, d)),
    "dq_profile_matches_flow": lambda s, d: C.same_by(profile(s, d), "dimension", ["sex", "age"], flow(s, d), ["territory", "month"], ["admissions", "separations"]),
    "dq_region_members_active": lambda s, d: T.territories(s, d).where("region is not null and not active").select("territory", "region"),
    "dq_wage_base_matches": lambda s, d: C.same_net(monthly(s, d), wages(s, d).join(F.broadcast(flagship(s, d).select(F.col("municipality").cast("string").alias("territory"))), "territory"), ["month"], ["n_wages"]),
    "dq_individual_wage": lambda s, d: ev(s, d).where(M.VALID_WAGE).where("wage > 50000").select("municipality", "month", "wage"),
    "dq_territory_without_reference": lambda s, d: T.territories(s, d).where("active").join(M.reference_by_territory(T.reference_stock(s, d), T.territories(s, d)), "territory", "left_anti").select("territory"),
    "dq_grain_stock": lambda s, d: C.repeated(levels(s, d), *GRAIN),
    "dq_grain_marts": lambda s, d: C.repeated_in({"flow": (flow(s, d), ["territory", "month", "grouping", "subgrouping", "division"]), "profile": (profile(s, d), ["territory", "month", "dimension", "category"]), "region": (region(s, d), ["region", "grouping", "month"]), "wage": (wages(s, d), ["territory", "month"])}),
    "dq_grain_monthly": lambda s, d: C.repeated(monthly(s, d), "month", "grouping"),
    "dq_anchor_adjustment": lambda s, d: adjustment(s, d).where("adjustment <> 0").select("territory", "grouping", "adjustment"),
    "dq_generic": generic,
    "dq_volume_anomaly": lambda s, d: C.volume_anomaly(movements(s, d).where("feed = 'MOV'").groupBy("municipality", "month").agg(F.sum("n").alias("n")), "municipality"),
    "dq_freshness": lambda s, d: movements(s, d).where("feed = 'MOV'").groupBy("municipality").agg(F.max("month").alias("month")).withColumn("days", F.datediff(F.lit("2002-01-31").cast("date"), months.month_end(F.col("month"))).cast("long")).where("days > 60"),
    "dq_summary": dq_summary,
    "fact_panorama": lambda s, d: X.panorama(total(s, d)),
    "fact_decomposition": lambda s, d: X.decomposition(total(s, d)),
    "fact_accumulated": lambda s, d: X.accumulated(total(s, d)),
    "fact_seasonality": lambda s, d: X.seasonality(levels(s, d)),
    "fact_sector": lambda s, d: X.sector(levels(s, d), flow(s, d)),
    "fact_highlights": lambda s, d: X.highlights(X.seasonality(levels(s, d))),
    "fact_persistence": lambda s, d: X.persistence(X.highlights(X.seasonality(levels(s, d))), levels(s, d)),
    "fact_drilldown": lambda s, d: X.drilldown(flow(s, d), X.highlights(X.seasonality(levels(s, d)))),
    "fact_comparison": lambda s, d: X.comparison(levels(s, d), region(s, d)),
    "fact_profile": lambda s, d: X.profile_share(profile(s, d)),
    "fact_wage": lambda s, d: X.wage(wages(s, d)),
    "fact_registry": lambda s, d: X.registry(total(s, d)),
    "fact_tables": lambda s, d: report(s, d).select("month", "grouping", "admissions", "separations", "net", "stock"),
    "fc_series": lambda s, d: P.series(total(s, d)),
    "fc_level_backcast": series,
    "fc_seasonal_rates": lambda s, d: P.seasonal_rates(series(s, d)),
    "fc_naive": lambda s, d: P.naive(series(s, d)),
    "fc_backtest": lambda s, d: P.backtest(series(s, d)),
    "fc_band": lambda s, d: P.band(P.backtest(series(s, d))),
    "fc_mae": lambda s, d: P.mae(P.backtest(series(s, d))),
    "fc_holt_winters": lambda s, d: P.holt_winters(series(s, d)),
    "fc_combined": forecast,
    "fc_methods": lambda s, d: P.methods(series(s, d)),
    "fc_backtest_methods": method_errors,
    "fc_band_combined": combined_band,
    "fc_mae_methods": lambda s, d: P.mae_methods(method_errors(s, d)),
    "fc_guards": guards,
    "ind_yoy": yearly,
    "ind_relative": relative,
    "code_check_digit": lambda s, d: T.territories(s, d).where("kind = 'municipality'").select("territory", check_digit(F.col("territory").cast("long")).alias("code7")),
    "text_numbers": lambda s, d: G.numbers(T.table(s, d, "documents")),
    "ungrounded_numbers": lambda s, d: A.ungrounded_counts(G.numbers(T.table(s, d, "documents")), text_facts(s, d)).select("doc_id", "place", "token"),
    "identification_flags": lambda s, d: G.identity(T.table(s, d, "documents")),
    "style_flags": lambda s, d: G.style(T.table(s, d, "documents")),
    "threshold_sweep": lambda s, d: A.sweep(scored(s, d)),
    "reliability_bins": lambda s, d: A.reliability(scored(s, d)),
    "ledger_run_cost": lambda s, d: A.ledger_runs(entries(s, d)).select("run", "calls", "cost"),
    "ledger_spend": lambda s, d: A.ledger_runs(entries(s, d)).select("run", "closed", "reserve", "committed"),
    "mart_vs_official": lambda s, d: A.compare(reconciled(s, d).select("month", "grouping", "net"), official(s, d), ["month", "grouping"], ["net"]),
    "feed_vs_staging": lambda s, d: A.multiset_difference(ev(s, d).where("feed = 'MOV'"), ev(s, d).where("feed = 'MOV' and sex is not null"), ["month", "section", "sign"]),
    "residual_category": lambda s, d: A.residual(report(s, d), "TOTAL", ["Agropecuária", "Indústria", "Construção", "Comércio", "Serviços"]),
    "event_windows": lambda s, d: T.table(s, d, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum(cents(F.col("value"))).alias("cents")).select(F.col("w.start").alias("day"), "event_type", "n", "cents"),
}

#: Runs of a text and the gaps about them, a row a run that begins with a digit, and its fields (what dots part).
_RUNS = """select doc_id, i, r[i] run, g[i] before, g[i+1] as after, r[i+1] nxt, string_split(r[i],'.') f from (select doc_id, regexp_extract_all(text, '[\\pL\\pN_.,]+') r, string_split_regex(text, '[\\pL\\pN_.,]+') g from documents), unnest(range(1, len(r)+1)) t(i)"""


def _figures(runs: str) -> str:
    """Judged runs: body (digits with dots), decimals, rest, whether it is in groups of three."""
    full = f"select *, coalesce(list_min(list_filter(range(2, len(f)+1), lambda j: not regexp_full_match(f[j], '[0-9]{{3}}'))), len(f)+1)-2 k from ({runs}) where regexp_matches(run, '^[0-9]')"
    groups = f"select *, case when regexp_full_match(f[1], '[0-9]{{1,3}}') then k+case when regexp_matches(coalesce(f[k+2],''), '^[0-9]{{3}},') then 1 else 0 end else 0 end gr from ({full})"
    body = f"select *, case when gr>0 then f[1]||'.'||array_to_string(list_transform(f[2:gr+1], lambda x: x[1:3]), '.') else regexp_extract(run, '^[0-9]+') end body from ({groups})"
    tail = f"select *, substr(run, length(body)+1) tail from ({body})"
    dec = f"select *, case when substr(tail, length(regexp_extract(tail,'^,[0-9]+'))+1, 1) in ('','.',',') then regexp_extract(tail,'^,[0-9]+') else '' end decimals from ({tail})"
    return f"select *, substr(tail, length(decimals)+1) rest from ({dec}) where substr(tail, length(decimals)+1, 1) in ('','.',',')"


def _pct(x: str, y: str) -> str:
    """100 x / y to two digits, halves away from zero."""
    return f"0+sign(1.0e0*({x}))*sign(1.0e0*({y}))*floor((20000*abs({x})+abs({y}))/nullif(2.0e0*abs({y}),0))/100.0e0"


TOTALS = {
    "tot": """select s.territory, s.month, coalesce(f.admissions,0) admissions, coalesce(f.separations,0) separations, s.net, s.stock from
 (select territory, month, cast(sum(net) as bigint) net, case when count(stock)=count(*) then cast(sum(stock) as bigint) end stock from level group by 1,2) s
 left join (select territory, month, cast(sum(admissions) as bigint) admissions, cast(sum(separations) as bigint) separations from flow group by 1,2) f using (territory, month)""",
    "season": """select territory, "grouping", month, net, min(net) over w low, max(net) over w high, count(net) over w as years from level window w as (partition by territory, "grouping", month%100 order by month rows between unbounded preceding and 1 preceding)""",
    "placed": """select *, case when years<3 then 'insufficient' when net>high then 'above' when net<low then 'below' else 'inside' end position from season""",
    "notable": """select territory, month, "grouping", net, position, rank, rest from (select *, cast(sum(net) filter (not chosen) over (partition by territory, month) as bigint) rest from (select *, fit and (rank<=2 or position in ('above','below')) chosen from (
 select *, row_number() over (partition by territory, month, fit order by abs(net) desc, "grouping") rank from (select *, "grouping"<>'Não Identificado' and abs(net)>=3 fit from placed)))) where chosen""",
    "ser": """select territory, month, admissions, separations, admissions-separations net, stock from (select *, count(*) over (partition by territory) n, (max(month) over (partition by territory)//100*12+max(month) over (partition by territory)%100)-(min(month) over (partition by territory)//100*12+min(month) over (partition by territory)%100)+1 span from tot) where n=span""",
    "back": """select territory, month, admissions, separations, net, cast(max_by(stock, month) over (partition by territory) - coalesce(sum(net) over (partition by territory order by month rows between 1 following and unbounded following),0) as bigint) as level from ser""",
    "ends_": "select territory, max(month) last, max_by(level, month) anchor from back group by 1",
    "ahead": "select e.*, h, ((last//100*12+last%100-1+h)//12)*100+(last//100*12+last%100-1+h)%12+1 as month from ends_ e, (select cast(unnest(range(1,25)) as bigint) h) x",
    "rates": """select territory, moy, avg(ra) ra, avg(rd) rd from (select territory, month%100 moy, ra, rd, row_number() over (partition by territory, month%100 order by month desc) k from (select *, admissions/nullif(lag(level) over (partition by territory order by month),0) ra, separations/nullif(lag(level) over (partition by territory order by month),0) rd from back) where ra is not null) where k<=3 group by 1,2""",
    "seas": "select territory, h, month, ra, rd, anchor*product(1+ra-rd) over (partition by territory order by h) lv from ahead join rates using (territory) where h<=12 and moy=month%100",
    "cumu": "select territory, month//100*12+month%100-1 t, level, sum(net) over (partition by territory order by month) c, row_number() over (partition by territory order by month) i from back",
    "errs": """select o.territory, ((o.t//12)*100+o.t%12+1) origin, h, cast(r.level-o.level-e.c+y.c as bigint) error from cumu o, (select unnest(range(1,13)) h) x, cumu e, cumu y, cumu r
 where o.i>24 and e.territory=o.territory and y.territory=o.territory and r.territory=o.territory and e.t=o.t+h-12 and y.t=o.t-12 and r.t=o.t+h""",
    "bandq": "select territory, h, count(*) n, quantile_cont(cast(error as double),0.1) lo, quantile_cont(cast(error as double),0.9) hi from errs group by 1,2 having count(*)>=8",
    "bandk": "select territory, max(h) k, max_by(lo,h) lo, max_by(hi,h) hi from bandq group by 1",
    "buy": """select 10+n_regionkey st, cast((10+n_regionkey)*10000+n_nationkey as varchar) town, cast(year(o_orderdate)*100+month(o_orderdate) as bigint) as month, c_custkey, cast(round(o_totalprice*100) as bigint) cents from orders join customer on c_custkey=o_custkey join nation on n_nationkey=c_nationkey""",
    "bt": "select town territory, month, count(distinct c_custkey) n, cast(sum(cents) as bigint) cents from buy group by 1,2",
    "bs": "select cast(st as varchar) territory, month, count(distinct c_custkey) n, cast(sum(cents) as bigint) cents from buy group by 1,2",
    "yt": "select a.territory, a.month, a.n, a.cents, 0+sign(1.0e0*((a.n-b.n)))*sign(1.0e0*(b.n))*floor((20000*abs((a.n-b.n))+abs(b.n))/nullif(2.0e0*abs(b.n),0))/100.0e0 growth_n, 0+sign(1.0e0*((a.cents-b.cents)))*sign(1.0e0*(b.cents))*floor((20000*abs((a.cents-b.cents))+abs(b.cents))/nullif(2.0e0*abs(b.cents),0))/100.0e0 growth_value from bt a join bt b on a.territory=b.territory and a.month=b.month+100",
    "ys": "select a.territory, a.month, 0+sign(1.0e0*((a.n-b.n)))*sign(1.0e0*(b.n))*floor((20000*abs((a.n-b.n))+abs(b.n))/nullif(2.0e0*abs(b.n),0))/100.0e0 growth_n from bs a join bs b on a.territory=b.territory and a.month=b.month+100",
    "sc": "select quality=1 truth, (doc_id*37%101)/100.0e0 p from labels",
    "led": "select user_id run, case event_type when 'signup' then 'reserve' when 'purchase' then 'call' when 'error' then 'close' end kind, ts, event_id, cast(round(value*100) as bigint) cents from events where event_type in ('signup','purchase','error')",
    "runs_": """select run, count(*) filter (kind='call') calls, cast(coalesce(sum(cents) filter (kind='call'),0) as bigint) as cost, coalesce(max_by(cents, row(ts, event_id)) filter (kind='reserve'),0) reserve, bool_or(kind='close') closed from led group by 1""",
    "facts": "select cast(o_orderkey as double) v from orders",
    "num": f"""select doc_id, cast(row_number() over (partition by doc_id order by i)-1 as int) place, token, mil, abs(value) v, value from (select *, try_cast(replace(replace(replace(token,'.',''),',','.'),'−','-') as double) as value from (
 select doc_id, i, case when right(before,1) in ('-','−') and (i=1 or length(before)>1) then right(before,1) else '' end||body||decimals token, rest='' and regexp_full_match(after,'[[:space:]]+') and coalesce(regexp_replace(lower(nxt),'[.,].*$','')='mil',false) mil from ({_figures(_RUNS)})))""",
    "said": "select abs(v) v, false mil from facts union select round(cast(v as decimal(24,6))*0.001,0), true from facts union select round(cast(v as decimal(24,6))*0.001,1), true from facts union select v/1000.0, true from facts",
    "offi": """select month, "grouping", case when month%13<>0 then net+case when month%7=0 then 1 else 0 end end net from rec where month%11<>0""",
}

_same = "coalesce(a.{v},0) {v}_left, coalesce(b.{v},0) {v}_right"


def _compare(left: str, right: str, keys: list[str], values: list[str]) -> str:
    k = ", ".join(f'"{x}"' for x in keys)
    sums = ", ".join(f"cast(sum({v}) as bigint) {v}" for v in values)
    return f"""select {k}, {", ".join(_same.format(v=v) for v in values)} from (select {k}, {sums} from ({left}) l_ group by all) a full join (select {k}, {sums} from ({right}) r_ group by all) b using ({k}) where {" or ".join(f"coalesce(a.{v},0)<>coalesce(b.{v},0)" for v in values)}"""


_f = lambda q: sql(q, **TOTALS)
_MISSING = "select k.{key}, m.{m} from (select distinct {key} from {rows}) k cross join (select cast(strftime(x,'%Y%m') as bigint) as {m} from (select unnest(generate_series(make_date(cast(min({m})//100 as int),cast(min({m})%100 as int),1), make_date(cast(max({m})//100 as int),cast(max({m})%100 as int),1), interval 1 month)) x from {rows})) m where not exists (select 1 from {rows} e where e.{key}=k.{key} and e.{m}=m.{m})"

SQL = {
    "dq_stock_coherent": _f('select territory, "grouping", month, net, moved from (select *, stock-lag(stock) over (partition by territory, "grouping" order by month) moved from level) where moved<>net'),
    "dq_reconciled_coherent": _f(_compare('select month, "grouping", net_mov net from rec', "select * from monthly", ["month", "grouping"], ["net"])),
    "dq_net_coherent": _f('select month, "grouping", net from monthly where net<>admissions-separations'),
    "dq_late_files_continuity": sql(_MISSING.format(key="feed", m="file_month", rows="late_"), late_="select feed, file_month from ev where feed<>'MOV'"),
    "dq_month_continuity": sql(_MISSING.format(key="municipality", m="month", rows="mv"), mv="select municipality, month from ev where feed='MOV'"),
    "dq_stock_matches_reference": _f("""select l.territory, l."grouping", l.stock, case when l.stock is not null then coalesce(r.reference,0) end reference from level l left join ref r on r.territory=l.territory and r."grouping"=l."grouping" where l.month=200012 and l.stock is distinct from case when l.stock is not null then coalesce(r.reference,0) end"""),
    "dq_unidentified_negative": _f("""select territory, "grouping", month, stock from level where "grouping"='Não Identificado' and stock<0"""),
    "dq_stock_non_negative": _f("""select territory, "grouping", month, stock from level where "grouping"<>'Não Identificado' and stock<0"""),
    "dq_region_sum": _f(_compare("select * from regional where net is not null", "select region, level.* from level join member using (territory)", ["region", "grouping", "month"], ["net"])),
    "dq_exclusion_sign": _f("select movement_type, count(*) n from ev join (select movement_type, min(sign) lo from ev where feed='MOV' group by 1 having min(sign)=max(sign)) c using (movement_type) where feed='EXC' and sign<>lo group by 1"),
    "dq_wage_range": _f("select territory, month, median_wage, mean_wage from wage where median_wage not between 500 and 6000 or mean_wage not between 500 and 6000"),
    "dq_flow_matches_stock": _f(_compare("select * from flow", "select * from level", ["territory", "grouping", "month"], ["net"])),
    "dq_flow_matches_reconciled": _f(_compare("select * from flow where territory=(select cast(municipality as varchar) from flag)", "select * from rec", ["month", "grouping"], ["admissions", "separations"])),
    "dq_mean_vs_median": _f('select month, "grouping", n_wages, median_wage, mean_wage from monthly where n_wages>=5 and mean_wage>1.2e0*median_wage'),
    "dq_profile_matches_flow": _f(" union all ".join("select *, '" + x + "' as dimension from (" + _compare(f"select * from profile where dimension='{x}'", "select * from flow", ["territory", "month"], ["admissions", "separations"]) + ")" for x in ("sex", "age"))),
    "dq_region_members_active": _f("select territory, region from terr where region is not null and not active"),
    "dq_wage_base_matches": _f(_compare("select * from monthly", "select * from wage where territory=(select cast(municipality as varchar) from flag)", ["month"], ["n_wages"])),
    "dq_individual_wage": _f("select municipality, month, wage from ev where sign=1 and wage_unit=5 and wage>50000"),
    "dq_territory_without_reference": _f("select territory from terr where active and territory not in (select territory from ref)"),
    "dq_grain_stock": _f('select territory, "grouping", month, count(*) n from level group by all having count(*)>1'),
    "dq_grain_marts": _f("""select 'flow' mart, count(*) n from flow group by territory, month, "grouping", subgrouping, division having count(*)>1 union all select 'profile', count(*) from profile group by territory, month, dimension, category having count(*)>1
 union all select 'region', count(*) from stock_region group by region, "grouping", month having count(*)>1 union all select 'wage', count(*) from wage group by territory, month having count(*)>1"""),
    "dq_grain_monthly": _f('select month, "grouping", count(*) n from monthly group by all having count(*)>1'),
    "dq_anchor_adjustment": _f('select territory, "grouping", adjustment from adjustment where adjustment<>0'),
    "dq_generic": _f("""select unnest(['sign','wage_unit','sex_known','age_known','section']) as rule, unnest([count(*) filter (sign not in (1,-1)), count(*) filter (wage_unit not in (1,2,3,4,5,6,7,99)), count(*) filter (sex is null), count(*) filter (age is null), count(*) filter (section='Z')]) violations from ev"""),
    "dq_volume_anomaly": _f("""select a.municipality, a.month, a.n, median(b.n) median_others from mm a join mm b on a.municipality=b.municipality and a.month<>b.month group by 1,2,3 having count(*)>=3 and a.n<0.5*median(b.n)""".replace("mm", "(select municipality, month, count(*) n from ev where feed='MOV' group by 1,2)")),
    "dq_freshness": _f("""select municipality, month, date_diff('day', last_day(make_date(cast(month//100 as int), cast(month%100 as int), 1)), date '2002-01-31') as days from (select municipality, max(month) as month from ev where feed='MOV' group by 1) where date_diff('day', last_day(make_date(cast(month//100 as int), cast(month%100 as int), 1)), date '2002-01-31')>60"""),
    "fact_panorama": _f("""select t.*, b.stock stock_before, y.net net_year_ago, y.stock stock_year_ago, 0+sign(1.0e0*((t.stock-b.stock)))*sign(1.0e0*(b.stock))*floor((20000*abs((t.stock-b.stock))+abs(b.stock))/nullif(2.0e0*abs(b.stock),0))/100.0e0 rate_month, 0+sign(1.0e0*((t.stock-y.stock)))*sign(1.0e0*(y.stock))*floor((20000*abs((t.stock-y.stock))+abs(y.stock))/nullif(2.0e0*abs(y.stock),0))/100.0e0 rate_year from tot t
 left join tot b on b.territory=t.territory and b.month//100*12+b.month%100+1=t.month//100*12+t.month%100 left join tot y on y.territory=t.territory and y.month+100=t.month"""),
    "fact_decomposition": _f("""select territory, month, x from_admissions, y from_separations, x+y change, case when x*y>0 and 3*least(abs(x),abs(y))>=greatest(abs(x),abs(y)) then 'both' when abs(x)>=abs(y) then 'admissions' else 'separations' end driver from (select t.territory, t.month, t.admissions-p.admissions x, p.separations-t.separations y from tot t join tot p on p.territory=t.territory and p.month+100=t.month)"""),
    "fact_accumulated": sql("select a.*, b.ytd ytd_year_ago from acc a left join acc b on b.territory=a.territory and b.month+100=a.month", **TOTALS, acc="""select territory, month, cast(sum(net) over (partition by territory, month//100 order by month) as bigint) ytd, case when count(*) over w=12 then cast(sum(net) over w as bigint) end last_12 from tot window w as (partition by territory order by month//100*12+month%100 range between 11 preceding and current row)"""),
    "fact_seasonality": _f("select * from placed"),
    "fact_sector": _f(f"""select x.territory, x.month, x."grouping", x.net, coalesce(f.admissions,0) admissions, coalesce(f.separations,0) separations, stock, {_pct("x.net", "b")} rate_month,
 {_pct("stock", "w")} share_of_stock, case when abs(t)>=5 then {_pct("x.net", "t")} end contribution, {_pct("abs(x.net)", "m")} share_of_movement
 from (select *, sum(net) over p t, sum(abs(net)) over p m, case when count(stock) over p=count(*) over p then sum(stock) over p end w, lag(stock) over (partition by territory, "grouping" order by month) b from level window p as (partition by territory, month)) x
 left join (select territory, month, "grouping", cast(sum(admissions) as bigint) admissions, cast(sum(separations) as bigint) separations from flow group by 1,2,3) f on f.territory=x.territory and f.month=x.month and f."grouping"=x."grouping" """),
    "fact_highlights": _f("select * from notable"),
    "fact_persistence": _f("""select n.territory, n.month, n."grouping", n.net, a.net net_1_before, b.net net_2_before from notable n
 left join level a on a.territory=n.territory and a."grouping"=n."grouping" and a.month//100*12+a.month%100+1=n.month//100*12+n.month%100
 left join level b on b.territory=n.territory and b."grouping"=n."grouping" and b.month//100*12+b.month%100+2=n.month//100*12+n.month%100"""),
    "fact_drilldown": sql(
        f"""select territory, "grouping", month, level, code, name, net, of_net-net net_of_rest, admissions, separations, net_year_ago, moved, {_pct("moved", "o")} share, rank from (
 select *, row_number() over (partition by territory, month order by abs(net) desc, "grouping", code) rank from (
 select *, max(level) over (partition by territory, "grouping", month) top from (
 select *, sum(moved) over (partition by territory, "grouping", level, month) o from yearly) x join (select territory, "grouping", level, count(distinct code) codes from acts group by 1,2,3) c using (territory, "grouping", level)
 where codes>1 and o>0 and moved>=0.4*o and code<>'NI') where level=top) where rank<=3""",
        **TOTALS,
        acts="""select territory, "grouping", month, 'subgrouping' level, subgrouping code, subgrouping name, admissions, separations, net from flow union all select territory, "grouping", month, 'division', division, description, admissions, separations, net from flow""",
        yearly="""select territory, "grouping", level, code, shown as month, of_net, min(name) as name, cast(coalesce(sum(admissions+separations) filter (back<12),0) as bigint) moved, cast(coalesce(sum(net) filter (back=0),0) as bigint) net,
 cast(coalesce(sum(admissions) filter (back=0),0) as bigint) admissions, cast(coalesce(sum(separations) filter (back=0),0) as bigint) separations, cast(coalesce(sum(net) filter (back=12),0) as bigint) net_year_ago
 from (select a.*, h.month shown, h.net of_net, (h.month//100*12+h.month%100)-(a.month//100*12+a.month%100) back from notable h join acts a on a.territory=h.territory and a."grouping"=h."grouping") where back between 0 and 12 group by 1,2,3,4,5,6""",
    ),
    "fact_comparison": sql(
        f"select c.*, {_pct('c.net', 'b.stock')} rate_month, {_pct('(c.stock-y.stock)', 'y.stock')} rate_year from compared c left join compared b on b.place=c.place and b.month//100*12+b.month%100+1=c.month//100*12+c.month%100 left join compared y on y.place=c.place and y.month+100=c.month",
        compared="select place, month, cast(sum(net) as bigint) net, cast(sum(stock) as bigint) stock from (select territory place, month, net, stock from level union all select region, month, net, stock from regional) group by 1,2 having count(*)=count(stock)",
    ),
    "fact_profile": sql("select *, not small_base and not unidentified and (abs(net)>=20 or coalesce(abs(change)>=5,false)) relevant from (select a.*, b.share share_year_ago, round(a.share-b.share,2) change, a.admissions<30 small_base, a.category='Não Identificado' unidentified from ps a left join ps b on b.territory=a.territory and b.dimension=a.dimension and b.category=a.category and b.month+100=a.month)", ps="""select territory, month, dimension, category, admissions, separations, net, case when sum(admissions) over p>0 then 0+sign(1.0e0*admissions)*floor((20000*abs(admissions)+sum(admissions) over p)/(2.0e0*sum(admissions) over p))/100.0e0 end share, cast(sum(admissions) over p as bigint) base from profile window p as (partition by territory, month, dimension)"""),
    "fact_wage": _f("select a.*, b.median_wage median_year_ago, 0+sign(1.0e0*((a.median_wage-b.median_wage)))*sign(1.0e0*(b.median_wage))*floor((20000*abs((a.median_wage-b.median_wage))+abs(b.median_wage))/nullif(2.0e0*abs(b.median_wage),0))/100.0e0 variation, a.n_wages<30 small_base from wage a left join wage b on b.territory=a.territory and b.month+100=a.month"),
    "fact_registry": _f("select territory||'/'||month||'/'||measure id, value, 'people' unit from (select territory, month, 'admissions' measure, admissions as value from tot union all select territory, month, 'separations', separations from tot union all select territory, month, 'net', net from tot union all select territory, month, 'stock', stock from tot) where value is not null"),
    "fact_tables": _f('select month, "grouping", admissions, separations, net, stock from report'),
    "fc_series": _f("select * from ser"),
    "fc_level_backcast": _f("select * from back"),
    "fc_seasonal_rates": _f("select territory, h, month, round(lv/(1+ra-rd)*ra,4) admissions, round(lv/(1+ra-rd)*rd,4) separations, round(lv,4) as level from seas"),
    "fc_naive": _f("""select a.territory, a.h, a.month, b.admissions, b.separations, cast(anchor+sum(b.admissions-b.separations) over (partition by a.territory order by a.h) as bigint) as level from ahead a join back b on b.territory=a.territory and b.month=a.month-100*((a.h+11)//12)"""),
    "fc_backtest": _f("select * from errs"),
    "fc_band": _f("""select territory, h, n, round(min(lo) over w,4) low, round(max(hi) over w,4) high from (select k.territory, x.h, q.n, coalesce(q.lo, k.lo*sqrt(1.0e0*x.h/k.k)) lo, coalesce(q.hi, k.hi*sqrt(1.0e0*x.h/k.k)) hi
 from bandk k cross join (select cast(unnest(range(1,25)) as bigint) h) x left join bandq q on q.territory=k.territory and q.h=x.h) z window w as (partition by territory order by h)"""),
    "fc_mae": _f("select territory, h, round(avg(abs(error)),4) mae from errs group by 1,2"),
    "ind_yoy": _f("select * from yt"),
    "ind_relative": _f("select a.territory, a.month, round(a.growth_n-b.growth_n,2) points from yt a join ys b on b.territory=left(a.territory,2) and b.month=a.month"),
    "code_check_digit": _f("""select territory, cast(c*10+(10-(select sum(case when p>9 then p-9 else p end) from (select (c//cast(10**(5-i) as bigint)%10)*(1+i%2) p from range(6) r(i)))%10)%10 as bigint) code7 from (select territory, cast(territory as bigint) c from terr where kind='municipality')"""),
    "text_numbers": _f("select doc_id, place, token, value, mil as thousands from num"),
    "ungrounded_numbers": _f("select doc_id, place, token from num where (mil or not (v=floor(v) and (v between 1 and 12 or v between 2019 and 2035))) and not exists (select 1 from said where said.v=num.v and said.mil=num.mil)"),
    "identification_flags": rf"select doc_id, cast(unnest(range(len(t))) as int) as place, unnest(t) as found from (select doc_id, regexp_extract_all(text, '{G.IDENTITY}') t from documents)",
    "style_flags": rf"""with r as ({_RUNS}), p as (select doc_id, count(*) n from ({_figures("select * from r")}) where rest='' and (gr>0 or length(body)<=3) and regexp_matches(after,'^[[:space:]]?%') and length(decimals)<>3 group by 1),
 m as (select doc_id, count(*) n from (select *, regexp_replace(before,'[[:space:]]$','') near from r where regexp_matches(run,'^[0-9]')) where right(near,1) in ('-','−') and case when length(near)=1 then i=1 else regexp_matches(near[-2],'[[:space:](\[:;]') end group by 1)
 select doc_id, rule, n from (select doc_id, unnest(['dash','phrase','relative_month','caveat']) rule,
 unnest([len(regexp_extract_all(text,'{G.STYLE['dash']}')), len(regexp_extract_all(lower(text),'{G.STYLE['phrase']}')), len(regexp_extract_all(lower(text),'{G.STYLE['relative_month']}')), len(regexp_extract_all(lower(text),'{G.STYLE['caveat']}'))]) n from documents) where n>0
 union all select doc_id, 'percent', n from p union all select doc_id, 'minus', n from m""",
    "threshold_sweep": _f("""select threshold, fp, fn, cost, accuracy, tied and k=(c+1)//2 best from (select *, row_number() over (partition by tied order by threshold) k, count(*) over (partition by tied) c from (select *, cost=min(cost) over () tied from (
 select threshold, count(*) filter (p>=threshold and not truth) fp, count(*) filter (p<threshold and truth) fn, 3*count(*) filter (p>=threshold and not truth)+count(*) filter (p<threshold and truth) as cost, round(count(*) filter ((p>=threshold)=truth)/count(*),4) accuracy from sc, (select unnest(range(1,10))/10.0e0 threshold) t group by 1)))"""),
    "reliability_bins": _f("select least(cast(floor(p*5) as bigint),4) bin, count(*) n, round(avg(cast(truth as int)),4) share_true from sc group by 1"),
    "ledger_run_cost": _f("select run, calls, cost from runs_"),
    "ledger_spend": _f("select run, closed, reserve, case when closed then cost else greatest(reserve, cost) end committed from runs_"),
    "mart_vs_official": _f("""select coalesce(a.month,b.month) as month, coalesce(a."grouping",b."grouping") as "grouping", 'net' measure, a.net ours, b.net official, case when a.month is null then 'missing here' when b.month is null then 'missing there' when a.net is not distinct from b.net then 'equal' when a.net is null or b.net is null then 'null against value' else 'different' end status, a.net-b.net delta from rec a full join offi b on a.month=b.month and a."grouping"=b."grouping" """),
    "feed_vs_staging": _f("select month, section, sign, count(*) n_left, count(sex) n_right from ev where feed='MOV' group by 1,2,3 having count(*)<>count(sex)"),
    "residual_category": _f("""select month, max(net) filter ("grouping"='TOTAL')-max(net) filter ("grouping"='Agropecuária')-max(net) filter ("grouping"='Indústria')-max(net) filter ("grouping"='Construção')-max(net) filter ("grouping"='Comércio')-max(net) filter ("grouping"='Serviços') residual from report group by 1"""),
    "event_windows": "select date_trunc('day', ts)::timestamp as day, event_type, count(*) n, cast(sum(cast(round(value*100) as bigint)) as bigint) cents from events group by 1,2",
}

SQL["dq_summary"] = "select *, case when violations=0 then 'PASS' when severity='warn' then 'WARN' else 'ERROR' end as status from (" + " union all ".join(f"select '{n}' as \"check\", '{'warn' if n in WARNED else 'error'}' as severity, count(*) as violations from ({SQL[n]})" for n in checks()) + ")"
