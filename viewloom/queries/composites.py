"""The composite business queries (ids Q)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from viewloom.plans import depot, mortality
from viewloom.queries.base import Tables, query
from viewloom.queries.windows import _FEED, _LATEST, _SEGMENTS


def decimals_as_doubles(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema]
    )


_UNTIL = 2001

_SNAPSHOT_SQL = f"""
with log as (select distinct *, case when ZPRVMUTID <> '' then 'X' else '' end as corr,
                    case when substring(ZMUTDATE, 5, 4) = '0101' then ZMUTJAAR else ZMUTJAAR + 1 end as by_
             from {{mutations}} m where ZVERW_DAT <= '20011231' and ZMUTJAAR <= {_UNTIL}),
seg as (with src as (select * from log) {_SEGMENTS}),
src as (select l.* exclude (ZPDEELID, ZVERBDR, ZPENREGID, ZPRVMUTID, ZGEBDAT),
               case when ZGEBDAT = '00000000' then '' else ZGEBDAT end as ZGEBDAT,
               case when segment > 0 then policy || '_' || segment else ZPDEELID end as ZPDEELID, sum(ZVERBDR) as ZVERBDR
        from log l left join seg on ZPDEELID = policy and ZVERW_DAT = p and MWYZVLGNR = c and ZMUTDATE = m group by all),
st as (select *, lead(ZMUTID) over (partition by ZPDEELID, ZVVAANTP, corr order by ZVERW_DAT, MWYZVLGNR, ZMUTDATE, ZMUTID) as nxt
       from (select distinct ZMUTID, ZPDEELID, ZVVAANTP, ZAANSTYP, ZVERW_DAT, MWYZVLGNR, ZMUTDATE, ZEVENTID, ZVSTATP, ZVVSTATP,
             ZTGZ_BDR, ZVERBDR, ZVSTATA, ZVVSTATA, ZTYPE, ZBSN1, ZSTEDAT, ZVZSTEDAT, corr from src)),
tx as (select src.*, st.ZVSTATP as o_ps, st.ZVVSTATP as o_vps, st.ZTGZ_BDR as o_prom, st.ZVSTATA as o_cs, st.ZVVSTATA as o_vcs,
              st.ZVERBDR as o_ins
       from src left join st on src.ZMUTID = st.nxt and src.ZVVAANTP = st.ZVVAANTP),
feed as ({_FEED}),
pers as ({_LATEST}),
n1 as (select policy, death, '' as x from pers where role = 'First' and purpose = 'Death' and event = 'E001'),
n2 as (select policy, death, '' as x from pers where role = 'Second' and purpose = 'Death' and event = 'E002'),
xs as (select * from st where corr = 'X'),
d1 as (select distinct ZPDEELID as policy, ZSTEDAT as death, 'X' as x from xs
       where ZEVENTID = 'B001' and ZPDEELID not in (select policy from n1) union select * from n1),
d2 as (select distinct ZPDEELID as policy, ZVZSTEDAT as death, 'X' as x from xs
       where ZEVENTID = 'B002' and ZTYPE = '508_ONLY' and ZPDEELID not in (select policy from n2) union select * from n2),
b1 as (select distinct policy, ps, vps, prom, ins, cs, vcs from (
         select a.ZPDEELID as policy, a.ZVSTATP as ps, a.ZVVSTATP as vps, a.ZTGZ_BDR as prom, a.ZVERBDR as ins, a.ZVSTATA as cs, a.ZVVSTATA as vcs,
                rank() over (partition by a.ZPDEELID order by a.ZVERW_DAT desc, a.MWYZVLGNR desc, a.ZMUTDATE desc) as r
         from st a join xs b on a.ZPDEELID = b.ZPDEELID and a.corr = '' and a.ZAANSTYP = '007' and a.ZMUTDATE <= b.ZSTEDAT
              and a.ZVERW_DAT <= b.ZVERW_DAT and b.ZEVENTID = 'B001') where r = 1),
b2 as (select distinct policy, ps, vps, prom, ins, cs, vcs from (
         select a.ZPDEELID as policy, a.ZVSTATP as ps, a.ZVVSTATP as vps, a.ZTGZ_BDR as prom, a.ZVERBDR as ins, a.ZVSTATA as cs, a.ZVVSTATA as vcs,
                rank() over (partition by a.ZPDEELID order by a.ZVERW_DAT desc, a.MWYZVLGNR desc, a.ZMUTDATE desc) as r
         from st a join xs b on a.ZPDEELID = b.ZPDEELID and a.corr = '' and a.ZAANSTYP in ('008', '015') and a.ZMUTDATE <= b.ZVZSTEDAT
              and a.ZVERW_DAT <= b.ZVERW_DAT and b.ZEVENTID = 'B002') where r = 1),
info as (select p.policy, d1.death as death_1, d1.x as x_1, g1.gender as gender_1, g1.bsn as bsn_1, g1.birth as birth_1,
                d2.death as death_2, d2.x as x_2, g2.gender as gender_2, g2.bsn as bsn_2, g2.birth as birth_2
         from (select distinct ZPDEELID as policy from tx) p
         left join d1 on p.policy = d1.policy left join d2 on p.policy = d2.policy
         left join pers g1 on p.policy = g1.policy and g1.role = 'First' and g1.purpose = 'GBB'
         left join pers g2 on p.policy = g2.policy and g2.role = 'Second' and g2.purpose = 'GBB'),
kept as (select * from tx where corr = ''
         union select tx.* from tx join d1 on ZPDEELID = policy and ZSTEDAT = death and x = 'X'
               where corr = 'X' and ZEVENTID = 'B001' and ZTYPE = '508_ONLY'
         union select tx.* from tx join d2 on ZPDEELID = policy and ZVZSTEDAT = death and x = 'X'
               where corr = 'X' and ZEVENTID = 'B002' and ZTYPE = '508_ONLY'),
closing as (select * from kept where ZEVENTID in ('B001', 'B002') and ZTYPE = '508_ONLY'),
rel as (select * from kept a where not exists (select 1 from closing b where a.ZPDEELID = b.ZPDEELID and a.ZVVAANTP = b.ZVVAANTP)
           or exists (select 1 from closing b where a.ZPDEELID = b.ZPDEELID and a.ZVVAANTP = b.ZVVAANTP and a.ZVERW_DAT <= b.ZVERW_DAT)),
spine as (select distinct s.*, y, snap
          from (select ZPDEELID as policy, ZAANSTYP as ctype, ZVZ_GROEP as grp, ZVVAANTP as cov, min(ZMUTJAAR) as y0 from rel group by all) s
          join (select unnest(range(1990, {_UNTIL} + 1)) as y) ys on y >= y0
          join (select unnest(['EoY Snapshot', 'BoY Snapshot']) as snap) k on true),
seq as (select *, min(ZMUTJAAR) over w as ok_year, min(by_) over w as ok_by from rel
        window w as (partition by ZPDEELID, ZVVAANTP order by ZVERW_DAT desc, MWYZVLGNR desc, ZMUTDATE desc, ZMUTID desc rows unbounded preceding)),
hit as (select *, ZMUTJAAR as y, 'EoY Snapshot' as snap from seq where ZMUTJAAR = ok_year
        union all select *, by_, 'BoY Snapshot' from seq where by_ = ok_by),
last_hit as (select ZPDEELID as policy, ZVVAANTP as cov, y, snap, ZTYPE as kind, ZEVENTID as event, ZVERW_DAT as p, MWYZVLGNR as c, ZMUTDATE as m
             from hit qualify row_number() over (partition by ZPDEELID, ZVVAANTP, y, snap
                  order by ZVERW_DAT desc, MWYZVLGNR desc, ZMUTDATE desc, ZMUTID desc, ZTYPE desc, ZEVENTID desc) = 1),
filled as (select policy, ctype, grp, cov, y, snap, last_value(kind ignore nulls) over w as kind, last_value(event ignore nulls) over w as event,
                  last_value(p ignore nulls) over w as p, last_value(c ignore nulls) over w as c, last_value(m ignore nulls) over w as m
           from spine left join last_hit using (policy, cov, y, snap)
           window w as (partition by policy, ctype, grp, cov, snap order by y)),
a as (select f.* from filled f left join d1 on f.policy = d1.policy
      where kind is not null and y >= 2000 and 1 = case
        when x = 'X' and ctype = '007' and y < left(death, 4)::int then (kind <> '508_ONLY')::int
        when x = 'X' and ctype = '007' and y > left(death, 4)::int then 0
        when x = 'X' and ctype = '007' and y = left(death, 4)::int and y = left(m, 4)::int and kind = '508_ONLY' then 1
        when kind <> '508_ONLY' then 1
        when y = left(m, 4)::int and snap = 'EoY Snapshot' and (event = 'E001' and ctype = '007'
             or event in ('E002', 'B002') and ctype in ('008', '015')) then 1 else 0 end),
sal as (select distinct ZMUTID, ZPDEELID, ZVERW_DAT, MWYZVLGNR, ZMUTDATE,
               last_value(case when ZLTSAL <> 0 then ZLTSAL end ignore nulls) over w as sal,
               last_value(case when ZLTSAL <> 0 then ZLTSALDT end ignore nulls) over w as sal_date,
               last_value(case when ZLTSAL <> 0 then ZBSSALAM end ignore nulls) over w as sal_base
        from rel window w as (partition by ZPDEELID order by ZVERW_DAT, MWYZVLGNR, ZMUTDATE, ZMUTID)),
addr as (select x.*, HH_INKOM as income from {{addresses}} x left join {{income}} i on x.POSTCODE = i.POSTCODE),
j as (select a.*, b.*, i.* exclude (policy), sal.sal, sal.sal_date, sal.sal_base,
             a1.POSTCODE as pc_1, a1.BUITENLAND as land_1, a1.income as inc_1, a2.POSTCODE as pc_2, a2.BUITENLAND as land_2, a2.income as inc_2,
             b1.ps as f_ps, b1.vps as f_vps, b1.cs as f_cs, b1.vcs as f_vcs, b1.ins as f_ins, b1.prom as f_prom,
             b2.ps as s_ps, b2.vps as s_vps, b2.cs as s_cs, b2.vcs as s_vcs, b2.ins as s_ins, b2.prom as s_prom,
             ctype = '007' as own, ctype in ('008', '015') as partner,
             nullif(left(death_1, 4), '')::int as dy_1, nullif(left(death_2, 4), '')::int as dy_2,
             snap = 'EoY Snapshot' or substring(death_1, 5, 4) = '0101' as counts_1,
             snap = 'EoY Snapshot' or substring(death_2, 5, 4) = '0101' as counts_2,
             case when birth_1 <> '' then y - left(birth_1, 4)::int end as age_1,
             case when y - left(birth_2, 4)::int between 0 and 999 then y - left(birth_2, 4)::int end as age_2
      from a left join rel b on a.policy = b.ZPDEELID and a.cov = b.ZVVAANTP and p = ZVERW_DAT and c = MWYZVLGNR and m = ZMUTDATE
      left join info i on a.policy = i.policy left join b1 on a.policy = b1.policy left join b2 on a.policy = b2.policy
      left join sal on a.policy = sal.ZPDEELID and p = sal.ZVERW_DAT and c = sal.MWYZVLGNR and m = sal.ZMUTDATE
      left join addr a1 on bsn_1 = a1.BSN and snap = a1.SNAPSHOT_TYPE and y >= a1.ADDR_VALID_FROM and y < a1.ADDR_VALID_TO
      left join addr a2 on bsn_2 = a2.BSN and snap = a2.SNAPSHOT_TYPE and y >= a2.ADDR_VALID_FROM and y < a2.ADDR_VALID_TO),
k as (select *, x_1 = 'X' and own and y = dy_1 and counts_1 as fix_1, x_2 = 'X' and partner and y = dy_2 and counts_2 as fix_2,
             event = 'E002' and partner and kind = '508_ONLY' as end_2, event = 'E001' and own or event = 'E002' and partner as plain,
             event in ('E001', 'B001') and own or event in ('E002', 'B002') and partner and kind = '508_ONLY'
               or coalesce(own and y = dy_1 and counts_1, false) as zero from j)
select 'LEGO' as VTA, event as ZEVENTID, policy as POLIS_ID, '' as CONTRACT_ID, policy || '#' || cov as AANSPRAAK_ID, y as RAPPORTAGE_MUTATIE_JAAR,
  strptime(m, '%Y%m%d')::date as MUTATIE_DATUM,
  strptime(substring(ZMUTID, 14, 14), '%Y%m%d%H%M%S') + to_microseconds(substring(ZMUTID, 28, 4)::bigint * 100) as VERWERKINGS_MOMENT,
  '0' as COMMERCIEEL_PRODUCT_CODE, '' as COMMERCIEEL_PRODUCT, ctype as AANSPRAAK_TYPE,
  case when ZVSTATA = '' then '0' else ZVSTATA end as AANSPRAAK_STATUS, ZVFINSTA as AANSPRAAK_FINANCIERINGS_STATUS, grp as VERZEKERINGS_GROEP,
  case when ZVSTATP = '' then '0' else ZVSTATP end as POLIS_STATUS, ZINDATPOL as INGANGSDATUM_POLIS,
  case when zero then 0 else ZVERBDR::double end as VERZEKERD_BEDRAG, case when zero then 0 else ZTGZ_BDR::double end as TOEGEZEGD_BEDRAG,
  policy as DEELNEMER_ID, gender_1 as VERZEKERDE_GESLACHT, bsn_1 as VERZEKERDE_BSN,
  case when bsn_1 in ('', '0', '000000000', '-99999999') then '' else upper(sha256(bsn_1)) end as VERZEKERDE_BSN_HASHED,
  strptime(nullif(birth_1, ''), '%Y%m%d')::date as VERZEKERDE_GEB_DATUM, strptime(nullif(death_1, ''), '%Y%m%d')::date as VERZEKERDE_STERFTE_DATUM,
  case when event in ('E001', 'B001') or (year(strptime(m, '%Y%m%d')) >= dy_1 and (snap = 'EoY Snapshot' or y > dy_1))
            or (y >= dy_1 and counts_1) then null else age_1 end as VERZEKERDE_LEEFTIJD,
  case when (event in ('E001', 'B001') and left(m, 4)::int = y) or (y = dy_1 and counts_1) then age_1 end as VERZEKERDE_STERFTE_LEEFTIJD,
  '' as VERZEKERDE_ROOK_STATUS, pc_1 as VERZEKERDE_POST_CODE, land_1 as VERZEKERDE_LAND,
  gender_2 as VERZORGDE_GESLACHT, bsn_2 as VERZORGDE_BSN,
  case when bsn_2 in ('', '0', '000000000', '-99999999') then '' else upper(sha256(bsn_2)) end as VERZORGDE_BSN_HASHED,
  strptime(birth_2, '%Y%m%d')::date as VERZORGDE_GEB_DATUM, strptime(nullif(death_2, ''), '%Y%m%d')::date as VERZORGDE_STERFTE_DATUM,
  case when partner and event not in ('E002', 'B002') then age_2 end as VERZORGDE_LEEFTIJD,
  case when partner and event in ('E002', 'B002') then age_2 end as VERZORGDE_STERFTE_LEEFTIJD,
  '' as VERZORGDE_ROOK_STATUS, pc_2 as VERZORGDE_POST_CODE, land_2 as VERZORGDE_LAND,
  case when fix_1 then f_ps when plain then o_ps when fix_2 then s_ps end as VORIGE_POLIS_STATUS,
  case when fix_1 then f_vps when plain then o_vps when fix_2 then s_vps end as VORIGE_VTA_POLIS_STATUS,
  case when fix_1 then coalesce(f_cs, '0') when plain then o_cs when fix_2 then s_cs end as VORIGE_AANSPRAAK_STATUS,
  case when fix_1 then f_vcs when plain then o_vcs when fix_2 then s_vcs end as VORIGE_VTA_AANSPRAAK_STATUS,
  case when event = 'E001' and own and kind = '508_ONLY' then o_ins::double when fix_1 then f_ins::double else 0 end as VORIGE_VERZEKERD_BEDRAG,
  case when event = 'E001' and own and kind = '508_ONLY' then o_prom::double when fix_1 then f_prom::double else 0 end as VORIGE_TOEGEZEGD_BEDRAG,
  case when end_2 and y = dy_2 then coalesce(o_cs, '0') when fix_2 then s_cs else '0' end as VORIGE_VERZORGDE_AANSPRAAK_STATUS,
  case when end_2 and y = dy_2 then coalesce(o_vcs, '') when fix_2 then s_vcs else '' end as VORIGE_VERZORGDE_VTA_AANSPRAAK_STATUS,
  case when end_2 then o_ins::double when fix_2 then s_ins::double else 0 end as VORIGE_VERZORGDE_VERZEKERD_BEDRAG,
  case when end_2 then o_prom::double when fix_2 then s_prom::double else 0 end as VORIGE_VERZORGDE_TOEGEZEGD_BEDRAG,
  ZWERKGID as WERKGEVER_CONTRACT_ID, sal::double as SALARIS, sal_date as DATUM_VASTSTELLING_SALARIS, sal_base::double as SALARIS_PENSIOENGRONDSLAG,
  MBETTCP as BETALING_TERM, MBETMCP as BETALING_MOMENT, ZVTAID as VTA_ID, cov as VTA_AANSPRAAK_TYPE, ZVVSTATA as VTA_AANSPRAAK_STATUS,
  ZVVSTATP as VTA_POLIS_STATUS, null as PENSIOEN_LEEFTIJD, x_1 as CORRECTION_APPLIED,
  case when kind = '508_ONLY' then 'Death Snapshot' else snap end as SNAPSHOT, inc_1 as VERZEKERDE_INKOMENSKLASSE, inc_2 as VERZORGDE_INKOMENSKLASSE,
  0 as VERZEKERDE_RATIO_TOEGEZEGD_BEDRAG, 0 as VERZORGDE_RATIO_TOEGEZEGD_BEDRAG
from k"""


@query("Q01_mortality_snapshot", _SNAPSHOT_SQL)
def _(t: Tables):
    params = mortality.SnapshotParams("20011231", _UNTIL)
    return decimals_as_doubles(mortality.mortality_snapshot(t.mutations, t.addresses, t.income, params))


@query(
    "Q02_depot_duration",
    """
with links as (select RELNR, TOESL_CAT_DLN as cat_link, r.RELNR_DEPOT, GRPNR, SALDO_VJ
               from {depot_relations} r join {depot_amounts} a on r.RELNR_DEPOT = a.RELNR_DEPOT and JAAR = '1999'
               where ZVALIDFRM = '20000101000000'),
rows as (select b.*, cat_link, RELNR_DEPOT, SALDO_VJ,
                ACT_FIN_TYPE in ('3', '7', '8') and ACT_TOESL_CAT in ('3', '4') as act,
                INACT_FIN_TYPE in ('3', '7', '8') and INACT_TOESL_CAT in ('3', '4') as inact
         from (select distinct * from {depot_base} d) b join links l on b.RELNR = l.RELNR and (l.GRPNR = '' or l.GRPNR = b.GRPNR)),
depots as (select distinct * from (
             select *, case when act and inact and cat_link = 'AI' then 'AI' when act and cat_link in ('A', 'AI') then 'A'
                       when inact and cat_link in ('I', 'AI') then 'I' else '' end as cat from rows) where cat <> ''),
moves as (select distinct RELNR, cat, cat_link, RELNR_DEPOT, SALDO_VJ, WYZ_VERWERK_DAT, VRG_J_SLD_VERSCHUL
          from depots join {depot_balances} m on RELNR_DEPOT = RELNR_PADDED where WYZ_VERWERK_DAT < '20000101'),
saldo as (select RELNR, cat, sum(SALDO_VJ) as saldo_vj from (
            select *, rank() over (partition by RELNR, RELNR_DEPOT, cat order by WYZ_VERWERK_DAT desc) as r from moves) where r = 1 group by 1, 2),
booked as (select d.RELNR, cat, sum(cast(replace(BOEK, ',', '.') as decimal(17,2))) as boek
           from depots d join (select distinct * from {depot_journal} x where BOEKCD not in ('651','652','653','654','655','656','657')) j
           on d.RELNR_DEPOT = j.RELNR group by 1, 2),
policies as (select distinct RELNR, VOLGNR, VZ_CD_PA, ACT_FIN_TYPE, ACT_TOESL_CAT, INACT_FIN_TYPE, INACT_TOESL_CAT, cat_link, RELNR_DEPOT, cat, SALDO_VJ as own
             from depots),
calc as (select p.RELNR, VOLGNR, VZ_CD_PA, saldo_vj, p.cat,
                case when boek <> 0 then cast(round(saldo_vj / boek, 0) as bigint) else 0 end as all_years, case when abs(all_years) < 1000 then all_years end as years
         from policies p join saldo s on p.RELNR = s.RELNR and p.cat = s.cat join booked b on p.RELNR = b.RELNR and p.cat = b.cat)
select RELNR, VOLGNR, VZ_CD_PA, cast(saldo_vj as double) as SALDO_VJ,
       case when cat in ('A', 'AI') and years > 0 then '' when cat in ('A', 'AI') then cast(-years as varchar) else '0' end as MAX_DUUR_INDEXATIE_ACT,
       case when cat in ('I', 'AI') and years > 0 then '' when cat in ('I', 'AI') then cast(-years as varchar) else '0' end as MAX_DUUR_INDEXATIE_INACT
from calc""",
)
def _(t: Tables):
    inputs = depot.DepotInputs(t.depot_base, t.depot_amounts, t.depot_relations, t.depot_balances, t.depot_journal)
    return decimals_as_doubles(depot.depot_duration(inputs, "20000315"))
