"""The raw school tables as plain DuckDB SQL over the driver's tables.

Written out in full, so that the oracle takes nothing from the Spark code: a
wrong rule in an adaptor shows as a difference.  ``{cutoff}`` in the
demographic extract is an optional filter on the order date.
"""

RAW_DEMOGRAPHIC = """
select cast(c_custkey as varchar) as organization_code, c_name as school_name,
       concat(' ', cast(_y as varchar), '-', cast(_y + 1 as varchar)) as accountability_year,
       case when _n = 1 and c_custkey % 10 = 0 then '<5'
            when _n = 1 and c_custkey % 10 = 1 then '-'
            else cast(_n * 100 as varchar) end as num_enrolled,
       cast(num_hispanic as varchar) as num_hispanic, cast(num_black as varchar) as num_black, cast(num_white as varchar) as num_white, cast(num_asian as varchar) as num_asian, cast(num_am_indian as varchar) as num_am_indian, cast(num_pacific_islander as varchar) as num_pacific_islander, cast(num_two_or_more as varchar) as num_two_or_more, cast(num_male as varchar) as num_male, cast(num_female as varchar) as num_female, cast(num_iep as varchar) as num_iep, cast(num_ell as varchar) as num_ell, cast(num_frl as varchar) as num_frl, cast(num_homeless as varchar) as num_homeless, cast(num_foster as varchar) as num_foster, cast(num_military as varchar) as num_military, cast(num_pre_k as varchar) as num_pre_k, cast(num_kindergarten as varchar) as num_kindergarten, cast(num_grade_01 as varchar) as num_grade_01, cast(num_grade_02 as varchar) as num_grade_02, cast(num_grade_03 as varchar) as num_grade_03, cast(num_grade_04 as varchar) as num_grade_04, cast(num_grade_05 as varchar) as num_grade_05, cast(num_grade_06 as varchar) as num_grade_06, cast(num_grade_07 as varchar) as num_grade_07, cast(num_grade_08 as varchar) as num_grade_08, cast(num_grade_09 as varchar) as num_grade_09, cast(num_grade_10 as varchar) as num_grade_10, cast(num_grade_11 as varchar) as num_grade_11, cast(num_grade_12 as varchar) as num_grade_12
from (select o_custkey, year(o_orderdate) as _y, count(*) as _n,
       sum(case when o_orderpriority = '1-URGENT' then 1 else 0 end) as num_hispanic,
       sum(case when o_orderpriority = '2-HIGH' then 1 else 0 end) as num_black,
       sum(case when o_orderpriority = '3-MEDIUM' then 1 else 0 end) as num_white,
       sum(case when o_orderpriority = '4-NOT SPECIFIED' then 1 else 0 end) as num_asian,
       sum(case when o_orderpriority = '5-LOW' then 1 else 0 end) as num_am_indian,
       sum(case when o_orderstatus = 'P' then 1 else 0 end) as num_pacific_islander,
       sum(case when o_orderpriority = '1-URGENT' and o_orderstatus = 'P' then 1 else 0 end) as num_two_or_more,
       sum(case when o_orderstatus = 'F' then 1 else 0 end) as num_male,
       sum(case when o_orderstatus = 'O' then 1 else 0 end) as num_female,
       sum(case when o_totalprice > 150000 then 1 else 0 end) as num_iep,
       sum(case when o_totalprice < 50000 then 1 else 0 end) as num_ell,
       sum(case when o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') then 1 else 0 end) as num_frl,
       sum(case when o_orderstatus = 'F' and o_orderpriority = '5-LOW' then 1 else 0 end) as num_homeless,
       sum(case when o_orderstatus = 'O' and o_orderpriority = '1-URGENT' then 1 else 0 end) as num_foster,
       sum(case when o_orderstatus = 'P' and o_orderpriority = '2-HIGH' then 1 else 0 end) as num_military,
       sum(case when month(o_orderdate) = 1 then 1 else 0 end) as num_pre_k,
       sum(case when month(o_orderdate) = 2 then 1 else 0 end) as num_kindergarten,
       sum(case when month(o_orderdate) = 3 then 1 else 0 end) as num_grade_01,
       sum(case when month(o_orderdate) = 4 then 1 else 0 end) as num_grade_02,
       sum(case when month(o_orderdate) = 5 then 1 else 0 end) as num_grade_03,
       sum(case when month(o_orderdate) = 6 then 1 else 0 end) as num_grade_04,
       sum(case when month(o_orderdate) = 7 then 1 else 0 end) as num_grade_05,
       sum(case when month(o_orderdate) = 8 then 1 else 0 end) as num_grade_06,
       sum(case when month(o_orderdate) = 9 then 1 else 0 end) as num_grade_07,
       sum(case when month(o_orderdate) = 10 then 1 else 0 end) as num_grade_08,
       sum(case when month(o_orderdate) = 11 then 1 else 0 end) as num_grade_09,
       sum(case when month(o_orderdate) = 12 then 1 else 0 end) as num_grade_10,
       sum(case when month(o_orderdate) = 1 then 1 else 0 end) as num_grade_11,
       sum(case when month(o_orderdate) = 2 then 1 else 0 end) as num_grade_12
      from orders {cutoff} group by o_custkey, year(o_orderdate)) a
join customer on o_custkey = c_custkey
"""

RAW_ASSESSMENT = """
select cast(l_partkey as varchar) as organization_code, p_name as school_name,
       concat(cast(_y as varchar), '-', cast(_y + 1 as varchar), ' ') as school_year,
       cast(_n as varchar) as num_students_enrolled,
       cast(math_num_tested as varchar) as math_num_tested,
       case when ((100 * _math) // _n) < 5 then '<5' when ((100 * _math) // _n) > 95 then '>95' when l_partkey % 40 = 3 then '-' when l_partkey % 40 = 4 then null else concat(cast(((100 * _math) // _n) as varchar), '.5') end as math_pct_proficient,
       cast((100 * math_pct_emergent) // _n as varchar) as math_pct_emergent, cast((100 * math_pct_approaches) // _n as varchar) as math_pct_approaches, cast((100 * math_pct_meets) // _n as varchar) as math_pct_meets, cast((100 * math_pct_exceeds) // _n as varchar) as math_pct_exceeds,
       cast(ela_num_tested as varchar) as ela_num_tested,
       case when ((100 * _ela) // _n) < 5 then '<5' when ((100 * _ela) // _n) > 95 then '>95' when l_partkey % 40 = 3 then '-' when l_partkey % 40 = 4 then null else concat(cast(((100 * _ela) // _n) as varchar), '.5') end as ela_pct_proficient,
       cast((100 * ela_pct_emergent) // _n as varchar) as ela_pct_emergent, cast((100 * ela_pct_approaches) // _n as varchar) as ela_pct_approaches, cast((100 * ela_pct_meets) // _n as varchar) as ela_pct_meets, cast((100 * ela_pct_exceeds) // _n as varchar) as ela_pct_exceeds
from (select l_partkey, year(l_shipdate) as _y, count(*) as _n,
       sum(case when l_returnflag = 'R' then 1 else 0 end) as _math,
       sum(case when l_discount > 0.05 then 1 else 0 end) as _ela,
       sum(case when l_linestatus = 'F' then 1 else 0 end) as math_num_tested,
       sum(case when l_linestatus = 'O' then 1 else 0 end) as ela_num_tested,
       sum(case when l_quantity <= 12 then 1 else 0 end) as math_pct_emergent,
       sum(case when l_quantity > 12 and l_quantity <= 25 then 1 else 0 end) as math_pct_approaches,
       sum(case when l_quantity > 25 and l_quantity <= 38 then 1 else 0 end) as math_pct_meets,
       sum(case when l_quantity > 38 then 1 else 0 end) as math_pct_exceeds,
       sum(case when l_tax <= 0.02 then 1 else 0 end) as ela_pct_emergent,
       sum(case when l_tax > 0.02 and l_tax <= 0.04 then 1 else 0 end) as ela_pct_approaches,
       sum(case when l_tax > 0.04 and l_tax <= 0.06 then 1 else 0 end) as ela_pct_meets,
       sum(case when l_tax > 0.06 then 1 else 0 end) as ela_pct_exceeds
      from lineitem group by l_partkey, year(l_shipdate)) a
join part on l_partkey = p_partkey
"""

RAW_ABSENTEEISM = """
select cast(l_partkey as varchar) as organization_code, p_name as school_name,
       p_brand as district_name,
       concat(cast(_y as varchar), '-', cast(_y + 1 as varchar)) as accountability_year,
       case when _n = 1 then '' else cast((100 * _hi) // _n as varchar) end
         as chronic_absenteeism_rate
from (select l_partkey, year(l_shipdate) as _y, count(*) as _n,
             sum(case when l_quantity > 40 then 1 else 0 end) as _hi
      from lineitem group by l_partkey, year(l_shipdate)) a
join part on l_partkey = p_partkey
"""

RAW_REGIONS = """
select cast(p_partkey as varchar) as organization_code,
       case when p_partkey % 50 = 7 then 'Alternative'
            when p_partkey % 50 = 8 then 'Charter' else r_name end as region
from part join region on p_partkey % 5 = r_regionkey where p_partkey % 97 <> 0
union all
select cast(p_partkey as varchar), 'Transformation Network' from part where p_size >= 45
"""

RAW_LOCATIONS = """
select cast(p_partkey as varchar) as organization_code, p_name as school_name,
       p_brand as address, p_type as city, 'NV' as state,
       cast(p_size as varchar) as zip_code
from part where p_partkey % 89 <> 0
"""

#: A later release: schools renamed, closed, or without their rows of ``{year}``.
RAW_DEMOGRAPHIC_REVISED = """
select * replace (if(organization_code::bigint % 40 = 1, school_name || ' Academy', school_name) as school_name)
from raw_demographic
where organization_code::bigint % 35 <> 7
  and not (organization_code::bigint % 25 = 3 and trim(accountability_year) like '{year}%')
"""
