"""SQL of the marts: named relations that the other queries' SQL builds on."""

from __future__ import annotations

RELATIONS = {
    "sectors": "select * from (values ('A',1,3),('B',5,9),('C',10,33),('D',35,35),('E',36,39),('F',41,43),('G',45,47),('H',49,53),('I',55,56),('J',58,63),('K',64,66),('L',68,68),('M',69,75),('N',77,82),('O',84,84),('P',85,85),('Q',86,88),('R',90,93),('S',94,96),('T',97,97),('U',99,99)) t(section, lo, hi)",
    "raw": """select cast(10+n_regionkey as bigint) state, cast((10+n_regionkey)*10000+n_nationkey as bigint) municipality,
 cast(year(l_shipdate)*100+month(l_shipdate) as bigint) as month,
 case when l_orderkey%20=0 then 'EXC' when l_orderkey%20 in (1,2) then 'FOR' else 'MOV' end feed,
 case when l_orderkey%20 not in (0,1,2) then cast(year(l_shipdate)*100+month(l_shipdate) as bigint)
  else least(cast(floor((year(l_shipdate)*12+month(l_shipdate)+l_partkey%12)/12)*100 + (year(l_shipdate)*12+month(l_shipdate)+l_partkey%12)%12 + 1 as bigint), cast(200111 as bigint)) end file_month,
 cast(case when l_linestatus='O' then 1 else -1 end as bigint) sign,
 cast(case when l_partkey%97=0 then 9999999 else (1+l_partkey%99)*100000+l_partkey%100000 end as bigint) subclass,
 cast(case when l_linestatus='O' then 10+l_linenumber%3 else 31+l_linenumber%3 end as bigint) movement_type,
 case when l_returnflag='R' then 1 else 5 end wage_unit, case when l_discount=0 then cast(0 as double) else l_extendedprice end wage,
 case when l_suppkey%11=0 then null when cast(l_quantity as int)%2=0 then 1 else 3 end sex,
 case when l_tax=0 then null else 14+cast(floor(cast(l_quantity as int)*6/5) as int) end age
 from lineitem join supplier on s_suppkey=l_suppkey join nation on n_nationkey=s_nationkey""",
    "ev": """select raw.*, coalesce(section,'Z') section, case when section='A' then 'Agropecuária' when section in ('B','C','D','E') then 'Indústria' when section='F' then 'Construção'
 when section='G' then 'Comércio' when section is null then 'Não Identificado' else 'Serviços' end as "grouping" from raw left join sectors on subclass<>9999999 and floor(subclass/100000) between lo and hi""",
    "terr": """select cast((10+n_regionkey)*10000+n_nationkey as varchar) territory, 'municipality' kind, case when n_nationkey<15 then 'R' || n_regionkey end region, n_nationkey<20 active from nation
 union all select cast(10+r_regionkey as varchar), 'state', null, true from region""",
    "refm": """select cast((10+n_regionkey)*10000+n_nationkey as varchar) municipality, cast(10+n_regionkey as varchar) state, coalesce(section,'Z') section,
 case when section='A' then 'Agropecuária' when section in ('B','C','D','E') then 'Indústria' when section='F' then 'Construção' when section='G' then 'Comércio' when section is null then 'Não Identificado' else 'Serviços' end as "grouping",
 cast(1+c_custkey%50 as bigint) stock from customer join nation on n_nationkey=c_nationkey left join sectors on 1+c_custkey%99 between lo and hi where c_nationkey<>19""",
    "fan": "select t.territory, e.*, case when feed='EXC' then -sign else sign end effect from ev e join terr t on t.active and t.territory = case when t.kind='state' then cast(e.state as varchar) else cast(e.municipality as varchar) end",
    "flag": "select municipality from (select municipality, count(*) n from ev group by 1 order by n desc, municipality limit 1)",
    "mov": "select * from ev where feed='MOV' and municipality=(select municipality from flag)",
    "valid": "select * from mov where sign=1 and wage_unit=5 and wage>0",
    "cuts": """select month, "grouping", count(*) n, quantile_disc(wage, 0.5) med, quantile_disc(wage, 0.4) p40, quantile_disc(wage, 0.9) p90, cast(sum(cast(round(wage*100) as bigint)) as bigint) c from valid group by 1,2""",
    "monthly": """select f.month, f."grouping", f.admissions, f.separations, f.net, coalesce(c.n,0) n_wages, c.med median_wage, ((2*c.c+c.n)//(2*c.n))/100.0e0 mean_wage, t.palma
 from (select month, "grouping", count(*) filter (sign=1) admissions, count(*) filter (sign=-1) separations, cast(sum(sign) as bigint) net from mov group by 1,2) f
 left join cuts c on c.month=f.month and c."grouping"=f."grouping"
 left join (select v.month, v."grouping", round(avg(wage) filter (wage>=p90)/nullif(avg(wage) filter (wage<=p40),0),4) palma from valid v join cuts q on q.month=v.month and q."grouping"=v."grouping" group by 1,2) t on t.month=f.month and t."grouping"=f."grouping" """,
    "rec": """select *, admissions-separations net, admissions_mov-separations_mov net_mov, cast((last_month//100*12+last_month%100)-(month//100*12+month%100) as bigint) as lag,
 case when (last_month//100*12+last_month%100)-(month//100*12+month%100)<12 then 'provisional' else 'consolidated' end status from (
 select *, admissions_mov+admissions_for-admissions_exc admissions, separations_mov+separations_for-separations_exc separations, (select max(month) from mov) last_month from (
 select month, "grouping", count(*) filter (sign=1 and feed='MOV') admissions_mov, count(*) filter (sign=1 and feed='FOR') admissions_for, count(*) filter (sign=1 and feed='EXC') admissions_exc,
 count(*) filter (sign=-1 and feed='MOV') separations_mov, count(*) filter (sign=-1 and feed='FOR') separations_for, count(*) filter (sign=-1 and feed='EXC') separations_exc
 from ev where municipality=(select municipality from flag) group by 1,2))""",
    "fl": """select territory, "grouping", month, cast(sum(effect) as bigint) net from fan group by 1,2,3""",
    "ref": """select t.territory, x."grouping", cast(sum(x.stock) as bigint) reference from refm x join terr t on t.active and t.territory=case when t.kind='state' then x.state else x.municipality end group by 1,2""",
    "spine": "select cast(strftime(d,'%Y%m') as bigint) as month from (select unnest(generate_series(make_date(cast(lo//100 as int),cast(lo%100 as int),1), make_date(cast(hi//100 as int),cast(hi%100 as int),1), interval 1 month)) d from (select min(month) lo, max(month) filter (feed='MOV') hi from ev))",
    "cells": """select distinct territory, "grouping" from (select territory, "grouping" from fl union all select territory, g from (select distinct territory from ref), (values ('Agropecuária'),('Indústria'),('Construção'),('Comércio'),('Serviços'),('Não Identificado')) v(g))""",
    "walk": """select c.territory, c."grouping", s.month, coalesce(f.net,0) net, sum(coalesce(f.net,0)) over (partition by c.territory, c."grouping" order by s.month) cum,
 sum(case when s.month<=200012 then coalesce(f.net,0) else 0 end) over (partition by c.territory, c."grouping") cref
 from cells c cross join spine s left join fl f on f.territory=c.territory and f."grouping"=c."grouping" and f.month=s.month""",
    "level": """select w.territory, w."grouping", w.month, w.net, case when w.territory in (select territory from ref) and (select max(month) from spine)>=200012 then cast(coalesce(r.reference,0)+cum-cref as bigint) end stock
 from walk w left join ref r on r.territory=w.territory and r."grouping"=w."grouping" """,
    "stock": """select *, net/nullif(lag(stock) over (partition by territory, "grouping" order by month),0) rate, case when territory in (select territory from ref) then cast(200012 as bigint) end reference_month from level""",
    "stock_from": """select territory, "grouping", month, net, stock, net/nullif(lag(stock) over (partition by territory, "grouping" order by month),0) rate, case when territory in (select territory from ref) then cast(200012 as bigint) end reference_month
 from (select territory, "grouping", month, net, case when month>=199901 then stock end stock from level)""",
    "own": """select territory, case when length(territory)>2 and cast(territory as bigint)%2=0 then 200012 else 199912 end anchor_month, case when length(territory)>2 and cast(territory as bigint)%2=0 then 200106 else 200006 end known_until from terr""",
    "member": "select region, territory from terr where active and region is not null",
    "regional": """select region, "grouping", month, case when count(net)=max(m) then cast(sum(net) as bigint) end net, case when count(stock)=max(m) then cast(sum(stock) as bigint) end stock
 from level join member using (territory) join (select region, count(*) m from member group by 1) using (region) group by 1,2,3""",
    "stock_region": """select *, net/nullif(lag(stock) over (partition by region, "grouping" order by month),0) rate from regional""",
    "divs": "select lpad(cast(1+p_partkey%99 as varchar),2,'0') division, min_by(p_name, p_partkey) description from part group by 1",
    "flow": """select f.* replace (case when f.division='NI' then 'Não identificada' else d.description end as description) from (select territory, month, "grouping",
 case when section='A' then 'Agropecuária' when section='C' then 'Indústrias de Transformação' when section in ('B','D','E') then 'Indústria geral' when section='F' then 'Construção' when section='G' then 'Comércio, reparação de veículos automotores e motocicletas'
 when section='H' then 'Transporte, armazenagem e correio' when section='I' then 'Alojamento e alimentação' when section in ('J','K','L','M','N') then 'Informação, comunicação e atividades financeiras, imobiliárias, profissionais e administrativas'
 when section in ('O','P','Q') then 'Administração pública, defesa, seguridade social, educação, saúde humana e serviços sociais' when section in ('R','S','U') then 'Outros serviços' when section='T' then 'Serviços domésticos' else 'Não Identificado' end subgrouping,
 case when subclass=9999999 then 'NI' else lpad(cast(subclass//100000 as varchar),2,'0') end division, null description,
 cast(coalesce(sum(case when feed='EXC' then -1 else 1 end) filter (sign=1),0) as bigint) admissions, cast(coalesce(sum(case when feed='EXC' then -1 else 1 end) filter (sign=-1),0) as bigint) separations, cast(sum(effect) as bigint) net from fan group by 1,2,3,4,5) f left join divs d on d.division=f.division""",
    "profile": """select territory, month, dimension, category, cast(coalesce(sum(case when feed='EXC' then -1 else 1 end) filter (sign=1),0) as bigint) admissions, cast(coalesce(sum(case when feed='EXC' then -1 else 1 end) filter (sign=-1),0) as bigint) separations, cast(sum(effect) as bigint) net from (
 select *, 'sex' dimension, case when sex=1 then 'Homem' when sex=3 then 'Mulher' else 'Não Identificado' end category from fan union all
 select *, 'age', case when age is null then 'Não Identificado' when age<=17 then 'até 17' when age<=24 then '18 a 24' when age<=29 then '25 a 29' when age<=39 then '30 a 39' when age<=49 then '40 a 49' when age<=64 then '50 a 64' else '65 ou mais' end from fan) group by 1,2,3,4""",
    "wage": """select territory, month, n n_wages, med median_wage, ((2*c+n)//(2*n))/100.0e0 mean_wage from (select territory, month, count(*) n, quantile_disc(wage,0.5) med, cast(sum(cast(round(wage*100) as bigint)) as bigint) c from fan where feed='MOV' and sign=1 and wage_unit=5 and wage>0 group by 1,2)""",
    "adjustment": """select territory, "grouping", count(*) as rows, cast(sum(effect) as bigint) adjustment, min(file_month) first_file, max(file_month) last_file from fan where feed<>'MOV' and month<=199912 and file_month>200006 group by 1,2""",
    "lines": """select coalesce(r.month,l.month) as month, coalesce(r."grouping",l."grouping") as "grouping", coalesce(r.admissions,0) admissions, coalesce(r.separations,0) separations, coalesce(r.net,0) net, l.stock, l.rate
 from rec r full join (select * from stock where territory=(select cast(municipality as varchar) from flag)) l on l.month=r.month and l."grouping"=r."grouping" """,
    "totals_": """select month, cast(sum(admissions) as bigint) admissions, cast(sum(separations) as bigint) separations, cast(sum(net) as bigint) net, case when count(stock)=count(*) then cast(sum(stock) as bigint) end stock from lines group by month""",
    "report": """select l.*, m.n_wages, m.median_wage, m.mean_wage, m.palma from lines l left join monthly m on m.month=l.month and m."grouping"=l."grouping" union all
 select t.month, 'TOTAL', t.admissions, t.separations, t.net, t.stock, t.net/nullif(b.stock,0), null, null, null, null from totals_ t left join totals_ b on b.month//100*12+b.month%100+1=t.month//100*12+t.month%100""",
    "total": """select month, admissions, separations, net, stock, rate from report where "grouping"='TOTAL'""",
    "summary": """select t.*, o.net_on_time, b.net net_month_before, y.net net_year_before from total t left join (select month, cast(sum(net_mov) as bigint) net_on_time from rec group by 1) o using (month)
 left join total b on b.month//100*12+b.month%100+1=t.month//100*12+t.month%100 left join total y on y.month+100=t.month""",
}


def sql(final: str, **more: str) -> str:
    """``final`` after the relations that it needs, in order (``more`` come last)."""
    import re

    known, need, todo = RELATIONS | more, set(), [final]
    while todo:
        text = todo.pop()
        for name in known:
            if name not in need and re.search(rf"(?:from|join|,)\s+\(?{name}\b|\bfrom {name}\b", text):
                need.add(name)
                todo.append(known[name])
    return "with " + ",\n".join(f"{n} as ({known[n]})" for n in known if n in need) + "\n" + final


SQL = {
    "stg_events": sql("select * from ev"),
    "stg_reference_stock": sql("select * from refm"),
    "effect_on_balance": sql('select territory, "grouping", month, file_month, feed, effect from fan'),
    "monthly_by_grouping": sql("select * from monthly"),
    "reconciled": sql("select * from rec"),
    "stock": sql("select * from stock"),
    "stock_region": sql("select * from stock_region"),
    "flow": sql("select * from flow"),
    "profile": sql("select * from profile"),
    "hiring_wage": sql("select * from wage"),
    "anchor_adjustment": sql("select * from adjustment"),
    "anchor_adjustment_own": sql("""select f.territory, f."grouping", count(*) as rows, cast(sum(effect) as bigint) adjustment, min(file_month) first_file, max(file_month) last_file
 from fan f join own o on o.territory=f.territory where feed<>'MOV' and f.month<=o.anchor_month and file_month>o.known_until group by 1,2"""),
    "report_series": sql("""select a.month, cast(row_number() over (partition by a.month order by b.month)-1 as int) place, b.month as at, b.admissions, b.separations, b.net, b.stock
 from (select *, row_number() over (order by month) k from total) a join (select *, row_number() over (order by month) k from total) b on b.k between a.k-11 and a.k"""),
    "report_source": sql("""select month, "grouping", admissions, separations, net, 'reconciled' as source, true has_mart from rec union all select month, "grouping", admissions, separations, net, 'on time', false from monthly"""),
    "stock_from": sql("select * from stock_from"),
    "report_table": sql("select * from report"),
    "report_summary": sql("select * from summary"),
}
