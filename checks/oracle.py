"""SQL of every query, for DuckDB on the same tables. Written against the tables, not against the Spark code.

``VIEWS`` are named sub-queries; a statement gets those it mentions, directly or through others, as CTEs.
"""

from __future__ import annotations

import re

from checks.queries import DESCRIBE_TEXT, MESSAGE_TEXT

AS_OF = "date '2024-01-31'"
K = "(user_id * 10 + event_id % 10)"
TYPE = """case when event_type = 'view' and event_id % 3 = 0 then 'documentation_view' when event_type = 'view' then 'website_visit'
 when event_type = 'click' and event_id % 4 = 1 then 'brochure_download' when event_type = 'click' then 'product_page_view'
 when event_type = 'signup' then 'demo_request' when event_type = 'purchase' then 'pricing_page_view' else 'unknown' end"""
PUBLIC = "('gmail.com','yahoo.com','hotmail.com','outlook.com','icloud.com','aol.com','protonmail.com','zoho.com','mail.com')"


def half_up(value: str) -> str:
    """Two places, halves away from zero, on the shortest decimal form of a double."""
    return f"cast(round(cast(cast({value} as varchar) as decimal(38,12)), 2) as double)"


def domain(value: str) -> str:
    return rf"regexp_replace(regexp_replace(lower(trim({value})), '^https?://(www\.)?', ''), '/.*$', '')"


def email_domain(value: str) -> str:
    return f"case when {value} like '%@_%' then split_part({value}, '@', -1) end"


def company(value: str) -> str:
    return f"case when {value} not in {PUBLIC} then {value} end"


def digest(*columns: str) -> str:
    return "sha256(" + " || '||' || ".join(f"coalesce(cast({c} as varchar), '')" for c in columns) + ")"


def phone(value: str) -> str:
    return f"case when trim({value}) like '+%' then '+' else '' end || regexp_replace({value}, '[^0-9]', '', 'g')"


def latest(source: str, key: str = "Id", order: str = "SystemModstamp desc") -> str:
    return f"(select * from {source} qualify row_number() over (partition by {key} order by {order}) = 1)"


def stamp(value: str) -> str:
    """ISO text -> the text form of an instant."""
    return f"strftime(cast(replace({value}, 'Z', '') as timestamp), '%Y-%m-%d %H:%M:%S')"


TAIL = f"""'salesforce' as source_system, Id as source_record_id, {stamp('CreatedDate')} as created_at,
  {stamp('SystemModstamp')} as updated_at"""

VIEWS = {
    "reps": "select 'srep_'||s_suppkey as sales_rep_id, s_name as name, lower(s_name)||'@corp.example.com' as email from supplier",
    "accounts": """select 'acc_'||c_custkey as account_id, c_name as account_name, c_mktsegment as industry,
        c_nationkey * 10 as employee_count, cast(cast(c_acctbal * 1000 as decimal(18,2)) as double) as annual_revenue,
        'd'||c_custkey||'.example.com' as website,
        case when c_custkey % 11 <> 0 then 'srep_'||(c_custkey % 120) end as owner_id from customer""",
    "contacts": """select 'cnt_'||c_custkey as contact_id,
        case when c_custkey % 23 <> 0 then 'acc_'||(c_custkey - c_custkey % 3) end as account_id from customer""",
    "opps": """select 'opp_'||o_orderkey as opportunity_id, 'acc_'||o_custkey as account_id,
        case when o_orderkey % 13 <> 0 then cast(o_totalprice as decimal(18,2)) end as amount,
        o_orderstatus <> 'O' as is_closed, o_orderstatus = 'F' as is_won, cast(o_orderdate as date) as close_date,
        case when o_orderkey % 17 <> 0 then 'srep_'||(o_orderkey % 120) end as owner_id from orders""",
    "leads": """select 'led_'||l_orderkey||'-'||l_linenumber as lead_id,
        case l_returnflag when 'R' then 'Web' when 'A' then 'Partner' end as lead_source, l_linestatus as status,
        case l_linenumber % 3 when 0 then 'Hot' when 1 then 'Warm' end as rating,
        cast(l_shipdate as date) - cast(l_quantity as int) as created_at, cast(l_shipdate as date) as updated_at,
        l_returnflag = 'R' as is_converted,
        case when l_returnflag = 'R' then 'acc_'||l_suppkey end as converted_account_id,
        case when l_returnflag = 'R' then 'cnt_'||l_partkey end as converted_contact_id,
        case when l_returnflag = 'R' then 'opp_'||(l_orderkey + case when l_partkey % 41 = 0 then 1000000000 else 0 end) end
          as converted_opportunity_id, l_partkey, l_suppkey, l_extendedprice
        from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
          order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) = 1""",
    "evts": f"""select 'evt_'||event_id as event_id, {TYPE} as event_type, ts as event_timestamp,
        cast(floor(value) as int) as duration_seconds,
        case when event_id % 50 = 7 then 'acc_'||{K}
             when event_id % 4 = 0 and {K} % 7 <> 0 then 'acc_'||({K} - {K} % 3)
             when event_id % 3 = 0 then 'acc_'||{K} end as account_id from events""",
    "per_contact": "select account_id, count(*) as contact_count from contacts where account_id is not null group by 1",
    "per_opp": """select account_id, count(*) filter (not is_closed) as open_opportunity_count,
        coalesce(cast(sum(amount) filter (not is_closed) as double), 0.0) as open_pipeline_value,
        count(*) filter (is_won) as won_opportunity_count,
        coalesce(cast(sum(amount) filter (is_won) as double), 0.0) as won_pipeline_value,
        count(*) filter (is_closed and not is_won) as lost_opportunity_count
        from opps where account_id is not null group by 1""",
    "per_event": f"""select account_id, strftime(max(event_timestamp), '%Y-%m-%d %H:%M:%S') as last_activity_at,
        max(event_timestamp) as last_ts,
        count(*) filter (event_timestamp >= {AS_OF} - 7) as events_last_7d,
        count(*) filter (event_timestamp >= {AS_OF} - 30) as events_last_30d
        from evts where account_id is not null group by 1""",
    "c360": """select a.account_id, a.account_name, a.industry, a.employee_count, a.annual_revenue, a.website,
        coalesce(c.contact_count, 0) as contact_count, coalesce(o.open_opportunity_count, 0) as open_opportunity_count,
        coalesce(o.open_pipeline_value, 0) as open_pipeline_value,
        coalesce(o.won_opportunity_count, 0) as won_opportunity_count,
        coalesce(o.won_pipeline_value, 0) as won_pipeline_value,
        coalesce(o.lost_opportunity_count, 0) as lost_opportunity_count, e.last_activity_at,
        coalesce(e.events_last_7d, 0) as events_last_7d, coalesce(e.events_last_30d, 0) as events_last_30d,
        a.owner_id as sales_rep_id, r.name as sales_rep_name, r.email as sales_rep_email
        from accounts a left join per_contact c using (account_id) left join per_opp o using (account_id)
        left join per_event e using (account_id) left join reps r on a.owner_id = r.sales_rep_id""",
    "intent": """select account_id, cast(event_timestamp as date) as event_date,
        count(*) filter (event_type = 'website_visit') as website_visits,
        count(*) filter (event_type = 'product_page_view') as product_views,
        count(*) filter (event_type = 'pricing_page_view') as pricing_views,
        count(*) filter (event_type = 'documentation_view') as documentation_views,
        count(*) filter (event_type = 'brochure_download') as brochure_downloads,
        count(*) filter (event_type = 'demo_request') as demo_requests,
        cast(coalesce(sum(duration_seconds), 0) as bigint) as total_duration_seconds, count(event_id) as engagement_score,
        cast(sum(case event_type when 'website_visit' then 1 when 'product_page_view' then 3 when 'documentation_view' then 3
          when 'brochure_download' then 5 when 'pricing_page_view' then 8 when 'demo_request' then 15 else 0 end) as bigint)
          as intent_score from evts where account_id is not null group by 1, 2""",
    "recent": f"""select account_id, cast(sum(intent_score) as bigint) as intent_score,
        cast(sum(engagement_score) as bigint) as engagement_score from intent where event_date >= {AS_OF} - 14 group by 1""",
    "prio_base": f"""select c.account_id, c.account_name, c.sales_rep_id, c.sales_rep_name,
        coalesce(r.intent_score, 0) as intent_score, coalesce(r.engagement_score, 0) as engagement_score,
        c.open_pipeline_value, c.open_opportunity_count,
        cast(coalesce(date_diff('day', cast(e.last_ts as date), {AS_OF}), 999) as int) as days_since_last_activity
        from c360 c left join recent r using (account_id) left join per_event e using (account_id)""",
    "prio_scored": f"""select *, {half_up('''(
          least(cast(100 as double), intent_score * cast(100 as double) / cast(50 as double)) * cast(0.40 as double)
        + least(cast(100 as double), open_pipeline_value * cast(100 as double) / cast(2000000 as double)) * cast(0.30 as double)
        + (case when days_since_last_activity <= 7 then cast(1.0 as double) when days_since_last_activity <= 14 then cast(0.7 as double)
             when days_since_last_activity <= 30 then cast(0.4 as double) else cast(0.1 as double) end) * cast(100 as double) * cast(0.20 as double)
        + (case when open_opportunity_count > 0 then cast(100 as double) else cast(0 as double) end) * cast(0.10 as double))''')}
        as priority_score from prio_base""",
    "prio": """select *, case when priority_score >= 70 then 'Tier 1' when priority_score >= 40 then 'Tier 2' else 'Tier 3' end
        as priority_band from prio_scored""",
    "perf_base": """select o.owner_id as sales_rep_id, r.name as sales_rep_name, strftime(o.close_date, '%Y-%m') as month,
        count(*) as opportunities_closed, count(*) filter (is_won) as won_opportunities,
        count(*) filter (is_closed and not is_won) as lost_opportunities,
        coalesce(sum(amount), 0) as pipeline_dec, coalesce(sum(amount) filter (is_won), 0) as won_dec,
        coalesce(sum(amount) filter (not is_closed), 0) as open_dec
        from opps o join reps r on o.owner_id = r.sales_rep_id group by 1, 2, 3""",
    "perf": """select sales_rep_id, sales_rep_name, month, opportunities_closed, won_opportunities, lost_opportunities,
        cast(pipeline_dec as double) as pipeline_closed, cast(won_dec as double) as won_revenue,
        cast(open_dec as double) as open_revenue,
        ((20000 * won_opportunities + opportunities_closed) // (2 * opportunities_closed)) / cast(100 as double) as win_rate,
        case when won_opportunities > 0 then cast(((2 * cast(won_dec * 100 as hugeint) + won_opportunities)
          // (2 * won_opportunities)) as double) / cast(100 as double) else cast(0 as double) end as average_deal_size
        from perf_base""",
    "attr": """select l.lead_id, l.lead_source, l.status, l.rating, strftime(l.created_at, '%Y-%m-%d') as created_at,
        l.is_converted, l.converted_account_id, l.converted_contact_id, l.converted_opportunity_id,
        case when l.is_converted then strftime(l.updated_at, '%Y-%m-%d') end as conversion_date,
        case when l.is_converted then cast(l.updated_at - l.created_at as int) end as days_to_conversion,
        coalesce(cast(o.amount as double), 0) as converted_opportunity_amount, coalesce(o.is_won, false) as is_won_deal
        from leads l left join opps o on l.converted_opportunity_id = o.opportunity_id""",
    # Landed CRM copies: the copy that counts only (the older one never wins), so these start where dedup ends.
    "landed_account_now": """select cast(c_custkey as varchar) as Id, '  '||c_name||' ' as Name,
        case c_nationkey % 3 when 0 then 'Customer ' when 1 then ' Prospect' end as Type,
        case when c_custkey % 13 = 0 then null
             when c_custkey % 2 = 0 then ' +1 ('||(c_custkey % 900 + 100)||') 555-'||(c_custkey % 9000 + 1000)
             else '('||(c_custkey % 900 + 100)||') 555.'||(c_custkey % 9000 + 1000)||' x' end as Phone,
        case when c_custkey % 17 = 0 then null
             when c_custkey % 10 = 5 then 'https://www.d'||(c_custkey - 1)||'.example.com'
             when c_custkey % 19 = 0 then 'http://www.GMAIL.com/'
             when c_custkey % 4 = 0 then 'https://www.d'||c_custkey||'.example.com/about/us'
             when c_custkey % 4 = 1 then 'HTTP://D'||c_custkey||'.Example.com'
             else '  d'||c_custkey||'.example.com ' end as Website,
        ' '||c_mktsegment as Industry,
        case when c_custkey % 19 <> 0 then cast(c_acctbal * 1000 as decimal(18,2)) end as AnnualRevenue,
        case when c_custkey % 29 <> 0 then c_nationkey * 10 end as NumberOfEmployees,
        case when c_custkey % 11 <> 0 then c_custkey % 120 end as OwnerId,
        '2023-01-01T00:00:00Z' as CreatedDate, '2024-01-02T08:30:00Z' as SystemModstamp from customer""",
    "landed_account_old": """select * replace ('old.example.com' as Website, '2023-06-01T00:00:00Z' as SystemModstamp)
        from landed_account_now""",
    "landed_account_all": "select * from landed_account_now union all select * from landed_account_old",
    "landed_contact_now": """select cast(c_custkey as varchar) as Id,
        case when c_custkey % 23 <> 0 then c_custkey - c_custkey % 3 end as AccountId,
        ' F'||c_custkey as FirstName, c_name||' ' as LastName,
        case when c_custkey % 7 = 0 then null
             when c_custkey % 10 = 3 then 'User'||(c_custkey - 1)||'@D'||(c_custkey - 1)||'.Example.com'
             when c_custkey % 31 = 0 then 'user'||c_custkey||'@gmail.com'
             else '  USER'||c_custkey||'@d'||c_custkey||'.EXAMPLE.com ' end as Email,
        '+44 '||(c_custkey % 90 + 10)||'-'||c_custkey as Phone,
        case c_nationkey % 4 when 0 then ' CTO' when 1 then 'Buyer ' end as Title, c_mktsegment as Department,
        case when c_custkey % 11 <> 0 then c_custkey % 120 end as OwnerId,
        '2023-02-01T00:00:00Z' as CreatedDate, '2024-01-03T09:00:00Z' as SystemModstamp from customer""",
    "landed_contact_all": """select * from landed_contact_now union all
        select * replace ('old@example.com' as Email, '2023-06-01T00:00:00Z' as SystemModstamp) from landed_contact_now""",
    "landed_opp_now": """select cast(o_orderkey as varchar) as Id,
        case when o_orderkey % 31 <> 0 then o_custkey end as AccountId, ' Deal '||o_orderkey as Name,
        case o_orderstatus when 'F' then 'Closed Won' when 'P' then 'Closed Lost ' else ' Open' end as StageName,
        case when o_orderkey % 13 <> 0 then cast(o_totalprice as decimal(18,2)) end as Amount,
        cast(o_orderkey % 101 as decimal(5,2)) as Probability,
        case when o_orderkey % 37 <> 0 then cast(o_orderdate as date) end as CloseDate, o_orderpriority as Type,
        case o_orderkey % 3 when 0 then 'Web ' when 1 then 'Partner' end as LeadSource,
        o_orderstatus <> 'O' as IsClosed, o_orderstatus = 'F' as IsWon,
        case when o_orderkey % 17 <> 0 then o_orderkey % 120 end as OwnerId,
        '2023-03-01T00:00:00Z' as CreatedDate, '2024-01-04T10:00:00Z' as SystemModstamp from orders""",
    "landed_lead_all": """select l_orderkey||'-'||l_linenumber as Id, * ,
        strftime(cast(l_shipdate as date) - cast(l_quantity as int), '%Y-%m-%dT00:00:00Z') as CreatedDate,
        strftime(l_shipdate, '%Y-%m-%dT00:00:00Z') as SystemModstamp from lineitem""",
    "s_account": f"""select 'acc_'||Id as account_id, trim(Name) as account_name, trim(Type) as account_type,
        {phone('Phone')} as phone, {domain('Website')} as website, trim(Industry) as industry,
        AnnualRevenue as annual_revenue, cast(NumberOfEmployees as int) as employee_count, 'srep_'||OwnerId as owner_id,
        {TAIL} from landed_account_now""",
    "s_contact": f"""select 'cnt_'||Id as contact_id, 'acc_'||AccountId as account_id, trim(FirstName) as first_name,
        trim(LastName) as last_name, lower(trim(Email)) as email, {phone('Phone')} as phone, trim(Title) as job_title,
        trim(Department) as department, 'srep_'||OwnerId as owner_id, {TAIL} from landed_contact_now""",
    "s_opp": f"""select 'opp_'||Id as opportunity_id, 'acc_'||AccountId as account_id, trim(Name) as opportunity_name,
        trim(StageName) as stage, Amount as amount, Probability as probability, CloseDate as close_date,
        trim(Type) as opportunity_type, trim(LeadSource) as lead_source, IsClosed as is_closed, IsWon as is_won,
        'srep_'||OwnerId as owner_id, {TAIL} from landed_opp_now""",
    "s_lead": f"""select 'led_'||Id as lead_id, 'F'||l_suppkey as first_name, 'L'||l_partkey as last_name,
        'Company '||l_suppkey as company_name, 'l'||l_partkey||'@d'||l_suppkey||'.example.com' as email,
        case l_returnflag when 'R' then 'Web' when 'A' then 'Partner' end as lead_source, l_linestatus as status,
        case l_linenumber % 3 when 0 then 'Hot' when 1 then 'Warm' end as rating, 'srep_'||l_suppkey as owner_id,
        l_returnflag = 'R' as is_converted,
        case when l_returnflag = 'R' then 'acc_'||l_suppkey end as converted_account_id,
        case when l_returnflag = 'R' then 'cnt_'||l_partkey end as converted_contact_id,
        case when l_returnflag = 'R' then 'opp_'||l_orderkey end as converted_opportunity_id, {TAIL}
        from {latest('landed_lead_all', order='SystemModstamp desc, l_partkey * 1000000 + l_suppkey desc, CreatedDate desc')}""",
    "s_role": f"""select 'ocr_'||Id as opportunity_contact_role_id,
        case when l_linenumber <> 7 then 'opp_'||(l_orderkey + l_partkey % 2 * 1000000) end as opportunity_id,
        case when l_partkey % 29 <> 0 then 'cnt_'||l_partkey end as contact_id,
        case l_returnflag when 'R' then 'Decision Maker' when 'A' then 'Evaluator' end as role,
        l_linenumber = 1 as is_primary, {TAIL}
        from {latest('landed_lead_all', order='SystemModstamp desc, l_partkey * 1000000 + l_suppkey desc, CreatedDate desc')}""",
    "s_rep": f"""select 'srep_'||s_suppkey as sales_rep_id, lower(s_name) as username, s_name as name,
        lower(s_name)||'@corp.example.com' as email,
        case when s_nationkey % 2 = 0 then 'Region '||s_nationkey end as role_name,
        s_suppkey % 3 <> 1 as is_active, 'salesforce' as source_system, cast(s_suppkey as varchar) as source_record_id,
        '2023-01-01 00:00:00' as created_at, '2024-01-02 08:30:00' as updated_at from supplier""",
    # Landed events: what the three messages of an event parse to.
    "copies": f"""select event_id as n, copy, {K} as cust, event_id * 3 + copy as _kafka_offset,
        cast(event_id % 8 as int) as _kafka_partition, event_id % 37 = 0 and copy = 1 as bad,
        case copy when 2 then {TYPE} else 'website_visit' end as etype,
        ts - case copy when 0 then interval 1 hour else interval 0 hour end as happened,
        {TYPE} as true_type, cast(floor(value) as int) * copy as seconds
        from events, (values (0), (1), (2)) as v(copy)""",
    "l_event": """select case when not bad then 'evt_'||n end as event_id, case when not bad then etype end as event_type,
        case when not bad then happened end as happened,
        case when bad then null when cust % 230 = 92 then '9' || cust when n % 100 = 57 then cast(cust as varchar) end as sfdc_contact_id,
        case when not bad and n % 50 = 7 then cast(cust as varchar) end as sfdc_account_id,
        case when not bad and n % 20 <> 0 then 'anon_'||cust end as anonymous_id,
        case when not bad and n % 4 = 0 then ' USER'||cust||'@d'||cust||'.Example.com' end as email,
        case when bad then null when n % 3 = 0 then 'https://www.D'||cust||'.example.com/x'
             when n % 3 = 1 then 'gmail.com' end as domain,
        case when not bad then 'https://example.com/'||(n % 10) end as url,
        case when not bad and true_type = 'pricing_page_view' then 'enterprise' end as plan_interest,
        case when not bad then seconds end as seconds, _kafka_offset, _kafka_partition from copies""",
    "id_event": f"""select anonymous_id, lower(trim(email)) as email, {company(domain('domain'))} as domain,
        sfdc_contact_id as direct_contact, sfdc_account_id as direct_account, happened as seen from l_event""",
    "id_all": f"""select * from id_event union all
        select null, email, {company(email_domain('email'))}, source_record_id,
          regexp_replace(account_id, '^acc_', ''), cast(updated_at as timestamp) from s_contact where email is not null
        union all
        select null, null, {company('website')}, null, source_record_id, cast(updated_at as timestamp)
          from s_account where website is not null""",
    "id_tuples": """select anonymous_id, email, domain, direct_contact, direct_account, min(seen) as f, max(seen) as l
        from id_all where anonymous_id is not null or email is not null or domain is not null group by all""",
    "by_email": """select email, min(contact_id) as email_contact_id, arg_min_null(account_id, contact_id) as email_account_id
        from s_contact where email is not null group by 1""",
    "by_domain": f"""select website as domain, min(account_id) as domain_account_id from s_account
        where website not in {PUBLIC} group by 1""",
    "id_groups": """select t.anonymous_id, t.email, t.domain,
        max(coalesce('cnt_'||t.direct_contact, e.email_contact_id)) as contact_id,
        max(coalesce('acc_'||t.direct_account, e.email_account_id, d.domain_account_id)) as account_id,
        min(f) as f, max(l) as l
        from id_tuples t left join by_email e on t.email = e.email left join by_domain d on t.domain = d.domain
        group by 1, 2, 3""",
    "id_stitched": """select anonymous_id, email, domain, f, l,
        case when anonymous_id is null then contact_id else first_value(contact_id ignore nulls) over w end as contact_id,
        case when anonymous_id is null then account_id else first_value(account_id ignore nulls) over w end as account_id
        from id_groups window w as (partition by anonymous_id
          order by contact_id desc nulls last, account_id desc nulls last
          rows between unbounded preceding and unbounded following)""",
    # The map once more, with its own rows as tuples that carry direct ids.
    "id_again": f"""select anonymous_id, email, domain, direct_contact, direct_account, min(f) as f, max(l) as l from (
        select * from id_tuples union all
        select anonymous_id, email, {company('domain')}, regexp_replace(contact_id, '^cnt_', ''), regexp_replace(account_id, '^acc_', ''), f, l
        from (select anonymous_id, email, domain, contact_id, account_id, f, l from id_stitched))
        where anonymous_id is not null or email is not null or domain is not null group by 1, 2, 3, 4, 5""",
    "id_groups_again": """select t.anonymous_id, t.email, t.domain,
        max(coalesce('cnt_'||t.direct_contact, e.email_contact_id)) as contact_id,
        max(coalesce('acc_'||t.direct_account, e.email_account_id, d.domain_account_id)) as account_id,
        min(f) as f, max(l) as l
        from id_again t left join by_email e on t.email = e.email left join by_domain d on t.domain = d.domain
        group by 1, 2, 3""",
    "id_stitched_again": """select anonymous_id, email, domain, f, l,
        case when anonymous_id is null then contact_id else first_value(contact_id ignore nulls) over w end as contact_id,
        case when anonymous_id is null then account_id else first_value(account_id ignore nulls) over w end as account_id
        from id_groups_again window w as (partition by anonymous_id
          order by contact_id desc nulls last, account_id desc nulls last
          rows between unbounded preceding and unbounded following)""",
    "anon_links": """select distinct anonymous_id, max(contact_id) over (partition by anonymous_id) as contact_id,
        first_value(account_id ignore nulls) over (partition by anonymous_id order by contact_id desc nulls last,
          account_id desc nulls last rows between unbounded preceding and unbounded following) as account_id
        from id_stitched where anonymous_id is not null""",
    "email_links": """select distinct email, max(contact_id) over (partition by email) as contact_id,
        first_value(account_id ignore nulls) over (partition by email order by contact_id desc nulls last,
          account_id desc nulls last rows between unbounded preceding and unbounded following) as account_id
        from id_stitched where email is not null""",
    "flat_event": """select * replace (lower(trim(email)) as email) from l_event where event_id is not null
        qualify row_number() over (partition by event_id order by happened desc, _kafka_partition desc, _kafka_offset desc) = 1""",
    "s_event": f"""select v.event_id, v.event_type, v.happened, coalesce(a.contact_id, e.contact_id) as contact_id,
        coalesce(a.account_id, e.account_id) as account_id, v.anonymous_id, v.email, {domain('v.domain')} as domain, v.url,
        v.plan_interest, cast(v.seconds as int) as duration_seconds
        from flat_event v left join anon_links a on v.anonymous_id = a.anonymous_id left join email_links e on v.email = e.email""",
    "described": f"select p_brand as object_name, {DESCRIBE_TEXT} as doc from part",
    "listed": """select object_name, f->>'name' as field_name, 'Direct' as field_type, f->>'label' as label,
        f->>'type' as data_type, cast(f->>'nillable' as boolean) as nillable
        from (select object_name, unnest(cast(json_extract(doc, '$.fields') as json[])) as f from described)""",
    "chosen": "select distinct p_brand as object_name, p_type as field_name from part where p_size % 3 > 0",
    "objects_listed": r"""select n as object_name, label, case when n like '%\_\_c' escape '\' then 'Custom Object'
        when n like '%\_\_change\_event' escape '\' then 'CDC Event Object'
        when n like '%\_\_Share' escape '\' or n like '%\_\_History' escape '\' then 'System / Security'
        else 'Standard Object' end as object_type, queryable, retrieveable, createable, updateable, custom
        from (select replace(s_name, '#', '_') || case s_suppkey % 5 when 0 then '__c' when 1 then '__change_event'
            when 2 then '__Share' when 3 then '__History' else '' end as n, 'Label ' || s_suppkey as label,
            s_suppkey % 2 = 0 as queryable, true as retrieveable, s_suppkey % 3 = 0 as createable, false as updateable,
            s_suppkey % 5 = 0 as custom from supplier
          union all select 'Nation' || s_nationkey, null, true, false, null, true, false from supplier)""",
    "inventory": """select l.*, case when c.field_name is not null then 'Required' else 'Optional / Evaluate' end as selection
        from listed l left join chosen c using (object_name, field_name)
        union all
        select distinct object_name, 'Owner.Name', 'Relationship Traversal', 'Owner.Name (SOQL Relationship Traversal)', 'reference_field', true,
          'Required' from chosen""",
}


def statement(sql: str) -> str:
    """Prepend the views that a statement mentions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                needed.append(name)

    visit(sql)
    return "with " + ",\n".join(f"{name} as ({VIEWS[name]})" for name in needed) + "\n" + sql if needed else sql


SEEN = "strftime(f, '%Y-%m-%d %H:%M:%S') as first_seen_at, strftime(l, '%Y-%m-%d %H:%M:%S') as last_seen_at"
IDN = digest("anonymous_id", "email", "domain")


def _code(condition: str, code: str) -> str:
    return f"case when {condition} then '{code}' end"


def _member(name: str) -> str:
    return f"json_type(j, '$.{name}')"


CONTRACT = ", ".join(
    [
        *(_code(f"not list_contains(json_keys(j), '{m}')", f"missing_{m}")
          for m in ("event_id", "event_type", "timestamp", "identity_resolution", "attributes")),
        _code(rf"{_member('event_id')} <> 'VARCHAR' or not regexp_full_match(j->>'event_id', 'evt_[a-zA-Z0-9_-]+')", "event_id"),
        _code(
            f"""{_member('event_type')} <> 'VARCHAR' or (j->>'event_type') not in ('website_visit','product_page_view',
            'pricing_page_view','documentation_view','demo_request','brochure_download')""",
            "event_type",
        ),
        _code(
            f"""{_member('timestamp')} <> 'VARCHAR' or not regexp_full_match(j->>'timestamp',
            '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}Z')""",
            "timestamp",
        ),
        _code(f"{_member('identity_resolution')} <> 'OBJECT'", "identity_resolution"),
        _code(
            """len(list_filter(json_keys(j, '$.identity_resolution'), lambda k: k not in
            ('sfdc_contact_id','sfdc_account_id','anonymous_id','email','domain'))) > 0""",
            "identity_resolution_extra",
        ),
        _code(
            """len(list_filter(json_keys(j, '$.identity_resolution'), lambda k:
            json_type(j, '$.identity_resolution.' || k) not in ('VARCHAR', 'NULL'))) > 0""",
            "identity_resolution_value",
        ),
        _code(f"{_member('attributes')} <> 'OBJECT'", "attributes"),
        _code(
            """len(list_filter(json_keys(j), lambda k: k not in
            ('event_id','event_type','timestamp','identity_resolution','attributes'))) > 0""",
            "extra",
        ),
    ]
)

QUERIES = {
    "customer_360": "select * from c360",
    "intent_engagement": "select * replace (strftime(event_date, '%Y-%m-%d') as event_date) from intent",
    "sales_prioritization": """select account_id, account_name, sales_rep_id, sales_rep_name, intent_score, engagement_score,
        open_pipeline_value, open_opportunity_count, days_since_last_activity, priority_score, priority_band from prio""",
    "sales_performance": "select * from perf",
    "lead_attribution": "select * from attr",
    "customer_360_from_landed": f"""select a.account_id, a.account_name, a.industry, a.employee_count,
        cast(a.annual_revenue as double) as annual_revenue, a.website, coalesce(c.n, 0) as contact_count,
        coalesce(o.n_open, 0) as open_opportunity_count, coalesce(o.v_open, 0) as open_pipeline_value,
        coalesce(o.n_won, 0) as won_opportunity_count, coalesce(o.v_won, 0) as won_pipeline_value,
        coalesce(o.n_lost, 0) as lost_opportunity_count, e.last_activity_at, coalesce(e.d7, 0) as events_last_7d,
        coalesce(e.d30, 0) as events_last_30d, a.owner_id as sales_rep_id, r.name as sales_rep_name, r.email as sales_rep_email
        from s_account a
        left join (select account_id, count(*) as n from s_contact group by 1) c using (account_id)
        left join (select account_id, count(*) filter (not is_closed) as n_open,
            coalesce(cast(sum(amount) filter (not is_closed) as double), 0) as v_open, count(*) filter (is_won) as n_won,
            coalesce(cast(sum(amount) filter (is_won) as double), 0) as v_won,
            count(*) filter (is_closed and not is_won) as n_lost from s_opp group by 1) o using (account_id)
        left join (select account_id, strftime(max(happened), '%Y-%m-%d %H:%M:%S') as last_activity_at,
            count(*) filter (happened >= {AS_OF} - 7) as d7, count(*) filter (happened >= {AS_OF} - 30) as d30
            from s_event group by 1) e using (account_id)
        left join s_rep r on a.owner_id = r.sales_rep_id""",
    "silver_account": f"""select * replace (cast(annual_revenue as double) as annual_revenue), {digest('account_name',
        'account_type', 'phone', 'website', 'industry', 'annual_revenue', 'employee_count', 'owner_id')} as record_hash from s_account""",
    "silver_contact": f"""select *, {digest('account_id', 'first_name', 'last_name', 'email', 'phone', 'job_title',
        'department', 'owner_id')} as record_hash from s_contact""",
    "silver_lead": f"""select *, {digest('first_name', 'last_name', 'company_name', 'email', 'lead_source', 'status',
        'rating', 'is_converted')} as record_hash from s_lead""",
    "silver_opportunity": f"""select * replace (cast(amount as double) as amount, cast(probability as double) as probability,
        strftime(close_date, '%Y-%m-%d') as close_date), {digest('account_id', 'opportunity_name', 'stage', 'amount',
        'probability', 'close_date', 'opportunity_type', 'is_closed', 'is_won', 'owner_id')} as record_hash from s_opp""",
    "silver_contact_role": f"select *, {digest('opportunity_id', 'contact_id', 'role', 'is_primary')} as record_hash from s_role",
    "silver_sales_rep": f"select *, {digest('username', 'name', 'email', 'role_name', 'is_active')} as record_hash from s_rep",
    "identity_sources_union": f"select anonymous_id, email, domain, direct_contact, direct_account, {SEEN} from id_tuples",
    "identity_email_match": """select t.* exclude (f, l), e.email_contact_id, e.email_account_id
        from id_tuples t left join by_email e on t.email = e.email""",
    "identity_domain_match": """select t.* exclude (f, l), d.domain_account_id
        from id_tuples t left join by_domain d on t.domain = d.domain""",
    "identity_groups": f"select anonymous_id, email, domain, contact_id, account_id, {SEEN} from id_groups",
    "identity_stitch": "select anonymous_id, email, domain, contact_id, account_id from id_stitched",
    "identity_map": f"""select 'idn_' || {IDN} as identity_id, anonymous_id, email, domain, contact_id, account_id, {SEEN}
        from id_stitched""",
    "identity_map_with_existing": f"""select 'idn_' || {IDN} as identity_id, anonymous_id, email, domain, contact_id, account_id, {SEEN}
        from id_stitched_again""",
    "identity_map_incremental": f"""select 'idn_' || {IDN} as identity_id, anonymous_id, email, domain, contact_id, account_id, {SEEN}
        from id_stitched""",
    "silver_customer_event": f"""select event_id, event_type, strftime(happened, '%Y-%m-%d %H:%M:%S') as event_timestamp, contact_id,
        account_id, anonymous_id, email, domain, url, plan_interest, duration_seconds,
        case event_type when 'website_visit' then 'low' when 'product_page_view' then 'medium' when 'documentation_view' then 'medium'
          when 'brochure_download' then 'medium_high' when 'pricing_page_view' then 'high' when 'demo_request' then 'very_high'
          else 'low' end as interaction_weight,
        '{{"url":"' || url || '",' || case when plan_interest is not null then '"plan_interest":"' || plan_interest || '",'
          else '"plan_interest":null,' end || '"duration_seconds":"' || duration_seconds || '"}}' as attributes,
        'digital_events' as source_system, event_id as source_record_id,
        {digest('event_type', 'happened', 'anonymous_id', 'email', 'contact_id', 'account_id', 'url', 'duration_seconds')} as record_hash
        from s_event""",
    "events_json_parse": """select event_id, event_type, strftime(happened, '%Y-%m-%d %H:%M:%S') as event_time, sfdc_account_id,
        anonymous_id, email, domain, url, cast(seconds as varchar) as duration_seconds, _kafka_offset, _kafka_partition,
        'digital_events' as _source_system from l_event""",
    "dedup_latest": """select lead_id, l_partkey, l_suppkey, l_extendedprice, strftime(updated_at, '%Y-%m-%d') as updated_at
        from leads""",
    "normalize_email": f"""select Id, SystemModstamp, lower(trim(Email)) as email,
        {email_domain('lower(trim(Email))')} as email_domain from landed_contact_all""",
    "normalize_domain": f"""select 'account ' || Id || SystemModstamp as origin, {domain('Website')} as domain from landed_account_all
        union all select 'page ' || page_id, {domain('url')} from pages""",
    "clean_phone": f"select Id, SystemModstamp, {phone('Phone')} as phone from landed_account_all",
    "record_hash": f"select opportunity_id, {digest('account_id', 'amount', 'is_won', 'owner_id')} as record_hash from opps",
    "safe_casts": """select Id || SystemModstamp as origin, cast(Amount as double) as amount, cast(Probability as double) as probability,
        strftime(CloseDate, '%Y-%m-%d') as close_date, IsWon as is_won, cast(null as int) as employees from landed_opp_now
        union all
        select Id || '2023-06-01T00:00:00Z', 1.0, cast(Probability as double), strftime(CloseDate, '%Y-%m-%d'), IsWon, null
        from landed_opp_now
        union all
        select 'account ' || Id || SystemModstamp, cast(AnnualRevenue as double), null, null, true, cast(NumberOfEmployees as int)
        from landed_account_all""",
    "date_functions": """select lead_id, strftime(updated_at, '%Y-%m') as month, cast(updated_at - created_at as int) as days_between,
        strftime(updated_at - 14, '%Y-%m-%d') as two_weeks_before, strftime(updated_at, '%Y-%m-%d 01:02:03') as parsed from leads""",
    "interaction_weight": """select event_id, event_type, case event_type when 'website_visit' then 'low'
        when 'product_page_view' then 'medium' when 'documentation_view' then 'medium' when 'brochure_download' then 'medium_high'
        when 'pricing_page_view' then 'high' when 'demo_request' then 'very_high' else 'low' end as interaction_weight from evts""",
    "event_intent_weight": """select event_id, event_type, case event_type when 'website_visit' then 1 when 'product_page_view' then 3
        when 'documentation_view' then 3 when 'brochure_download' then 5 when 'pricing_page_view' then 8
        when 'demo_request' then 15 else 0 end as weight from evts""",
    "recency_factor": f"""select event_id, event_type, cast({AS_OF} - cast(event_timestamp as date) as int) as days,
        cast(case when {AS_OF} - cast(event_timestamp as date) <= 7 then 1.0 when {AS_OF} - cast(event_timestamp as date) <= 14 then 0.7
        when {AS_OF} - cast(event_timestamp as date) <= 30 then 0.4 else 0.1 end as double) as factor,
        cast(0.1 as double) as factor_of_unknown from evts""",
    "priority_band": """select c_custkey, case when c_acctbal / 100 >= 70 then 'Tier 1' when c_acctbal / 100 >= 40 then 'Tier 2'
        else 'Tier 3' end as priority_band from customer""",
    "public_domain_filter": f"""select Id, SystemModstamp, d as domain, {company('d')} as company_domain from
        (select *, {email_domain('lower(trim(Email))')} as d from landed_contact_all)""",
    "clean_nonfinite": """select o_orderkey, case when o_orderkey % 4 = 3 then o_totalprice end as price,
        cast(case when o_orderkey % 5 > 1 then 1.5 end as float) as rate from orders""",
    "contacts_per_account": "select * from per_contact",
    "opps_per_account": "select * from per_opp",
    "trailing_activity": "select account_id, last_activity_at, events_last_7d, events_last_30d from per_event",
    "intent_14d": "select * from recent",
    "incremental_extract": """select *, 'salesforce' as _source_system, 'batch' as _batch_id from (
        select 'lead' as object_name, Id, SystemModstamp from landed_lead_all where l_shipdate > timestamp '1998-06-30'
        union all select 'opportunity_contact_role', Id, SystemModstamp from landed_lead_all where l_shipdate > timestamp '1997-01-01'
        union all select 'account', Id, SystemModstamp from landed_account_all
          where cast(replace(SystemModstamp, 'Z', '') as timestamp) > timestamp '2023-12-31'
        union all select 'contact', Id, SystemModstamp from landed_contact_all
          where cast(replace(SystemModstamp, 'Z', '') as timestamp) > timestamp '2023-06-01'
        union all select 'opportunity', Id, SystemModstamp from landed_opp_now
        union all select 'opportunity', Id, '2023-06-01T00:00:00Z' from landed_opp_now
        union all select 'user', cast(s_suppkey as varchar), '2024-01-02T08:30:00Z' from supplier)""",
    "high_water_mark": """select 'lead' as object_name, strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') as high_water,
        count(*) as row_count from lineitem
        union all select 'opportunity_contact_role', strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S'), count(*) from lineitem
        union all select 'account', '2024-01-02 08:30:00', count(*) from landed_account_all
        union all select 'contact', '2024-01-03 09:00:00', count(*) from landed_contact_all
        union all select 'opportunity', '2030-01-01 00:00:00', 2 * count(*) from orders
        union all select 'user', '2024-01-02 08:30:00', 2 * count(*) from supplier""",
    "event_contract_violations": f"""select message_no, array_to_string(codes, ',') as violations,
        cast(len(codes) as int) as violation_count from (
          select message_no, case when j is not null then list_filter([{CONTRACT}], lambda c: c is not null) else ['malformed'] end as codes
          from (select message_no, case when json_valid(txt) then txt end as j from (select event_id as message_no, {MESSAGE_TEXT} as txt from events)))""",
    "orphans_account_owner": """select owner_id, count(*) as orphan_rows from accounts
        where owner_id is not null and owner_id not in (select sales_rep_id from reps) group by 1""",
    "orphans_opportunity_owner": """select owner_id, count(*) as orphan_rows from opps
        where owner_id is not null and owner_id not in (select sales_rep_id from reps) group by 1""",
    "integrity_report": """select 'contact_account' as rule, count(*) as orphan_rows from s_contact
        where account_id not in (select account_id from s_account)
        union all select 'opportunity_account', count(*) from s_opp where account_id not in (select account_id from s_account)
        union all select 'role_opportunity', count(*) from s_role where opportunity_id not in (select opportunity_id from s_opp)
        union all select 'role_contact', count(*) from s_role where contact_id not in (select contact_id from s_contact)""",
    "mart_audit": """select 'customer_360' as mart, 'account_id' as key_column, count(*) as row_count,
          count(distinct account_id) as distinct_keys from c360
        union all select 'intent_engagement', 'account_id', count(*), count(distinct account_id) from intent
        union all select 'sales_prioritization', 'account_id', count(*), count(distinct account_id) from prio
        union all select 'sales_performance', 'sales_rep_id', count(*), count(distinct sales_rep_id) from perf
        union all select 'lead_attribution', 'lead_id', count(*), count(distinct lead_id) from attr""",
    "serve_customers": """select account_id, account_name, industry, employee_count, annual_revenue, contact_count,
        open_opportunity_count, open_pipeline_value, won_opportunity_count, won_pipeline_value, lost_opportunity_count
        from c360 where lower(industry) = 'machinery' order by account_id limit 20 offset 5""",
    "serve_customers_after": """select account_id, account_name, industry, employee_count, annual_revenue, contact_count,
        open_opportunity_count, open_pipeline_value, won_opportunity_count, won_pipeline_value, lost_opportunity_count
        from c360 where lower(industry) = 'machinery' and account_id > 'acc_5' order by account_id limit 50""",
    "serve_intent_after": """select account_id, strftime(min(event_date), '%Y-%m-%d') as window_start_date,
        strftime(max(event_date), '%Y-%m-%d') as window_end_date, cast(sum(website_visits) as bigint) as website_visits,
        cast(sum(product_views) as bigint) as product_views, cast(sum(pricing_views) as bigint) as pricing_views,
        cast(sum(documentation_views) as bigint) as documentation_views, cast(sum(demo_requests) as bigint) as demo_requests,
        cast(sum(intent_score) as double) as intent_score from intent where account_id > 'acc_3' group by 1
        order by account_id limit 200""",
    "top_priority_after": """select account_id, account_name, sales_rep_id, sales_rep_name,
        cast(intent_score as double) as intent_score, open_pipeline_value, priority_score, priority_band from prio
        where priority_score < 55 or priority_score = 55 and account_id > 'acc_3' order by priority_score desc, account_id limit 300""",
    "serve_sales_performance_after": """select sales_rep_id, sales_rep_name, month, opportunities_closed as total_opportunities,
        won_opportunities, lost_opportunities, open_revenue as open_pipeline_value, won_revenue as won_pipeline_value,
        win_rate, average_deal_size as avg_deal_size from perf
        where sales_rep_id > 'srep_3' or sales_rep_id = 'srep_3' and month > '1996-07' order by sales_rep_id, month limit 300""",
    "serve_lead_attribution_after": """select lead_id, lead_source, is_converted, converted_account_id as account_id,
        converted_opportunity_id as opportunity_id, converted_opportunity_amount as opportunity_amount, is_won_deal as is_won
        from attr where lead_source = 'Partner' and not coalesce(is_converted, false) and lead_id > 'led_2' order by lead_id limit 500""",
    "serve_account": """select account_id, account_name, industry, employee_count, annual_revenue, contact_count,
        open_opportunity_count, open_pipeline_value, won_opportunity_count, won_pipeline_value, lost_opportunity_count
        from c360 where account_id = 'acc_42'""",
    "serve_intent": """select account_id, strftime(min(event_date), '%Y-%m-%d') as window_start_date,
        strftime(max(event_date), '%Y-%m-%d') as window_end_date, cast(sum(website_visits) as bigint) as website_visits,
        cast(sum(product_views) as bigint) as product_views, cast(sum(pricing_views) as bigint) as pricing_views,
        cast(sum(documentation_views) as bigint) as documentation_views, cast(sum(demo_requests) as bigint) as demo_requests,
        cast(sum(intent_score) as double) as intent_score from intent group by 1 order by account_id limit 100 offset 10""",
    "serve_intent_latest": """select * replace (strftime(event_date, '%Y-%m-%d') as event_date) from intent
        qualify row_number() over (partition by account_id order by event_date desc) = 1""",
    "top_priority_accounts": """select account_id, account_name, sales_rep_id, sales_rep_name,
        cast(intent_score as double) as intent_score, open_pipeline_value, priority_score, priority_band from prio
        where priority_band = 'Tier 2' order by priority_score desc, account_id limit 50""",
    "serve_sales_performance": """select sales_rep_id, sales_rep_name, month, opportunities_closed as total_opportunities,
        won_opportunities, lost_opportunities, open_revenue as open_pipeline_value, won_revenue as won_pipeline_value,
        win_rate, average_deal_size as avg_deal_size from perf where month = '1997-05' order by sales_rep_id limit 200""",
    "serve_lead_attribution": """select lead_id, lead_source, is_converted, converted_account_id as account_id,
        converted_opportunity_id as opportunity_id, converted_opportunity_amount as opportunity_amount, is_won_deal as is_won
        from attr where lead_source = 'Web' and is_converted order by lead_id limit 500 offset 50""",
    "account_names": "select distinct account_name from c360",
    "account_intent_lookup": """select account_id, account_name, strftime(event_date, '%Y-%m-%d') as event_date, website_visits,
        product_views, pricing_views, documentation_views, demo_requests, cast(intent_score as double) as intent_score
        from intent join (select min(account_id) as account_id, account_name from c360
          where account_name = 'Customer#000000012' group by 2) using (account_id) order by event_date desc limit 1""",
    "executive_kpis": """select count(*) as total_accounts,
        cast(sum(cast(c.open_pipeline_value as decimal(18,2))) as double) as total_open_pipeline,
        cast(sum(cast(c.won_pipeline_value as decimal(18,2))) as double) as total_won_revenue,
        count(*) filter (p.priority_band = 'Tier 1') as tier_1_accounts from c360 c join prio p using (account_id)""",
    "priority_distribution": "select priority_band, count(*) as accounts from prio group by 1",
    "event_type_breakdown": "select event_type, count(*) as events from l_event group by 1",
    "lead_source_summary": """select lead_source, count(*) as total_leads, count(*) filter (is_converted) as converted_leads,
        count(*) filter (is_won_deal) as won_deals,
        cast(sum(cast(converted_opportunity_amount as decimal(18,2))) as double) as won_revenue
        from attr where lead_source is not null group by 1""",
    "rep_revenue_breakdown": """select sales_rep_id, sales_rep_name, cast(sum(won_dec) as double) as won_pipeline_value,
        cast(sum(open_dec) as double) as open_pipeline_value, cast(sum(pipeline_dec) as double) as all_pipeline_value
        from perf_base group by 1, 2""",
    "field_inventory": """select object_name, field_name, field_type, data_type, nillable, selection, count(*) as fields,
        min(label) as first_label from inventory group by 1, 2, 3, 4, 5, 6""",
    "field_count_pivot": """select object_name, count(*) filter (field_type = 'Direct') as "Direct",
        count(*) filter (field_type = 'Relationship Traversal') as "Relationship Traversal", count(*) as total_required
        from inventory where selection = 'Required' group by 1""",
    "names_per_group": """select object_name, string_agg(distinct field_name, ', ' order by field_name) as names,
        count(distinct field_name) as name_count from inventory where selection = 'Required' group by 1""",
    "object_inventory": "select * from objects_listed",
    "object_type_breakdown": "select object_type, count(*) as objects from objects_listed group by 1",
    "custom_objects": "select object_name, label from objects_listed where custom",
    "object_type_classify": """select n as object_name, case when n like '%\\_\\_c' escape '\\' then 'Custom Object'
        when n like '%\\_\\_change\\_event' escape '\\' then 'CDC Event Object'
        when n like '%\\_\\_Share' escape '\\' or n like '%\\_\\_History' escape '\\' then 'System / Security'
        else 'Standard Object' end as object_type
        from (select 'Obj' || o_orderkey || case o_orderkey % 6 when 0 then '__c' when 1 then '__change_event' when 2 then '__Share'
          when 3 then '__History' when 4 then '__C' else '' end as n from orders)""",
}


def oracle() -> dict[str, str]:
    return {name: statement(sql) for name, sql in QUERIES.items()}
