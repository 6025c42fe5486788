"""The test tables seen as customer data.

Two levels: typed tables as the marts take them, and landed tables (raw CRM copies, JSON messages) as the canonical
transforms take them. Every table is built from all rows of its source; nulls, bad values, duplicates and orphans come
from values, not from leaving rows out. ``oracle.py`` holds the same definitions in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountweave.operators.crm import ACCOUNT, CONTACT, LEAD, OPPORTUNITY, OPPORTUNITY_CONTACT_ROLE, SALES_REP, canonical
from accountweave.operators.dedup import keep_latest
from accountweave.session import use_runtime_settings
from accountweave.sources.staging import stage
from accountweave.streaming.events import parse_events

AS_OF = "2024-01-31"

#: Rows of a source that one task takes, where they are dealt out.
TASK_ROWS = 500_000

# All six event types, and one that is unknown.
EVENT_TYPE = """case event_type
 when 'view' then case when event_id % 3 = 0 then 'documentation_view' else 'website_visit' end
 when 'click' then case when event_id % 4 = 1 then 'brochure_download' else 'product_page_view' end
 when 'signup' then 'demo_request' when 'purchase' then 'pricing_page_view' else 'unknown' end"""

# The customer an event points at.
CUSTOMER = "(user_id * 10 + event_id % 10)"


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = use_runtime_settings(spark, sf_dir)
        self.sf_dir = sf_dir

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def spread_source(self, name: str) -> DataFrame:
        """The table over all cores, for work that is heavy per row.

        The test tables are one file of one row group each, which no setting of split sizes divides; such a table is
        moved once. What counts is the rows of the splits, for a split without the middle of a row group has none. A table
        of as many filled splits as cores, none of them large, is left as it is.
        """
        df, cores = self.source(name), self.spark.sparkContext.defaultParallelism
        splits = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
        found = splits.agg(F.count("*").alias("filled"), F.max("n").alias("most"), F.sum("n").alias("all")).first()
        if found["filled"] >= cores and found["most"] <= 3 * TASK_ROWS:
            return df
        return df.repartition(max(cores, -(-(found["all"] or 0) // TASK_ROWS)))

    # Typed tables.

    @cached_property
    def sales_reps(self) -> DataFrame:
        return self.source("supplier").selectExpr(
            "concat('srep_', s_suppkey) as sales_rep_id",
            "s_name as name",
            "concat(lower(s_name), '@corp.example.com') as email",
        )

    @cached_property
    def accounts(self) -> DataFrame:
        return self.source("customer").selectExpr(
            "concat('acc_', c_custkey) as account_id",
            "c_name as account_name",
            "c_mktsegment as industry",
            "c_nationkey * 10 as employee_count",
            "cast(c_acctbal * 1000 as decimal(18,2)) as annual_revenue",
            "concat('d', c_custkey, '.example.com') as website",
            "case when c_custkey % 11 <> 0 then concat('srep_', c_custkey % 120) end as owner_id",
        )

    @cached_property
    def contacts(self) -> DataFrame:
        return self.source("customer").selectExpr(
            "concat('cnt_', c_custkey) as contact_id",
            "case when c_custkey % 23 <> 0 then concat('acc_', c_custkey - c_custkey % 3) end as account_id",
            "case when c_custkey % 7 <> 0 then concat('user', c_custkey, '@d', c_custkey, '.example.com') end as email",
        )

    @cached_property
    def opportunities(self) -> DataFrame:
        return self.source("orders").selectExpr(
            "concat('opp_', o_orderkey) as opportunity_id",
            "concat('acc_', o_custkey) as account_id",
            "case when o_orderkey % 13 <> 0 then cast(o_totalprice as decimal(18,2)) end as amount",
            "o_orderstatus <> 'O' as is_closed",
            "o_orderstatus = 'F' as is_won",
            "cast(o_orderdate as date) as close_date",
            "case when o_orderkey % 17 <> 0 then concat('srep_', o_orderkey % 120) end as owner_id",
        )

    @cached_property
    def lead_copies(self) -> DataFrame:
        return self.spread_source("lineitem").selectExpr(
            "concat('led_', l_orderkey, '-', l_linenumber) as lead_id",
            "case l_returnflag when 'R' then 'Web' when 'A' then 'Partner' end as lead_source",
            "l_linestatus as status",
            "case l_linenumber % 3 when 0 then 'Hot' when 1 then 'Warm' end as rating",
            "date_sub(cast(l_shipdate as date), cast(l_quantity as int)) as created_at",
            "cast(l_shipdate as date) as updated_at",
            "l_returnflag = 'R' as is_converted",
            "case when l_returnflag = 'R' then concat('acc_', l_suppkey) end as converted_account_id",
            "case when l_returnflag = 'R' then concat('cnt_', l_partkey) end as converted_contact_id",
            """case when l_returnflag = 'R' then
                concat('opp_', l_orderkey + case when l_partkey % 41 = 0 then 1000000000 else 0 end)
               end as converted_opportunity_id""",
            "l_partkey",
            "l_suppkey",
            "l_extendedprice",
        )

    @cached_property
    def leads(self) -> DataFrame:
        newest = ["updated_at", "l_partkey", "l_suppkey", "l_extendedprice"]
        return keep_latest(self.lead_copies, ["lead_id"], newest)

    @cached_property
    def events(self) -> DataFrame:
        """Events with the account they resolve to, as the marts take them."""
        return self.source("events").selectExpr(
            "concat('evt_', event_id) as event_id",
            f"{EVENT_TYPE} as event_type",
            "ts as event_timestamp",
            "cast(floor(value) as int) as duration_seconds",
            f"""case when event_id % 50 = 7 then concat('acc_', {CUSTOMER})
                 when event_id % 4 = 0 and {CUSTOMER} % 7 <> 0 then concat('acc_', {CUSTOMER} - {CUSTOMER} % 3)
                 when event_id % 3 = 0 then concat('acc_', {CUSTOMER}) end as account_id""",
        )

    # Landed tables: the copy that counts, and an older copy of every record.

    def _with_older(self, landed: DataFrame, **older: str) -> DataFrame:
        changed = landed.withColumns({name: F.expr(value) for name, value in older.items()})
        return landed.unionByName(changed)

    @cached_property
    def landed_users(self) -> DataFrame:
        now = self.source("supplier").selectExpr(
            "cast(s_suppkey as string) as Id",
            "concat(' ', lower(s_name), ' ') as Username",
            "concat(s_name, '  ') as Name",
            "concat(' ', upper(s_name), '@CORP.example.com') as Email",
            "case s_suppkey % 3 when 0 then true when 1 then false end as IsActive",
            "case when s_nationkey % 2 = 0 then concat('Region ', s_nationkey) end as UserRole_Name",
            "'2023-01-01T00:00:00Z' as CreatedDate",
            "'2024-01-02T08:30:00Z' as SystemModstamp",
        )
        return self._with_older(now, Name="'old'", SystemModstamp="'2023-06-01T00:00:00Z'")

    @cached_property
    def landed_accounts(self) -> DataFrame:
        now = self.spread_source("customer").selectExpr(
            "cast(c_custkey as string) as Id",
            "concat('  ', c_name, ' ') as Name",
            "case c_nationkey % 3 when 0 then 'Customer ' when 1 then ' Prospect' end as Type",
            """case when c_custkey % 13 = 0 then null
                 when c_custkey % 2 = 0 then concat(' +1 (', c_custkey % 900 + 100, ') 555-', c_custkey % 9000 + 1000)
                 else concat('(', c_custkey % 900 + 100, ') 555.', c_custkey % 9000 + 1000, ' x') end as Phone""",
            """case when c_custkey % 17 = 0 then null
                 when c_custkey % 10 = 5 then concat('https://www.d', c_custkey - 1, '.example.com')
                 when c_custkey % 19 = 0 then 'http://www.GMAIL.com/'
                 when c_custkey % 4 = 0 then concat('https://www.d', c_custkey, '.example.com/about/us')
                 when c_custkey % 4 = 1 then concat('HTTP://D', c_custkey, '.Example.com')
                 else concat('  d', c_custkey, '.example.com ') end as Website""",
            "concat(' ', c_mktsegment) as Industry",
            """case when c_custkey % 19 = 0 then 'n/a'
                 else cast(cast(c_acctbal * 1000 as decimal(18,2)) as string) end as AnnualRevenue""",
            "case when c_custkey % 29 = 0 then 'many' else concat(c_nationkey * 10, '.7') end as NumberOfEmployees",
            "case when c_custkey % 11 <> 0 then cast(c_custkey % 120 as string) end as OwnerId",
            "'2023-01-01T00:00:00Z' as CreatedDate",
            "'2024-01-02T08:30:00Z' as SystemModstamp",
        )
        return self._with_older(now, Name="'old'", Website="'old.example.com'", SystemModstamp="'2023-06-01T00:00:00Z'")

    @cached_property
    def landed_contacts(self) -> DataFrame:
        now = self.spread_source("customer").selectExpr(
            "cast(c_custkey as string) as Id",
            "case when c_custkey % 23 <> 0 then cast(c_custkey - c_custkey % 3 as string) end as AccountId",
            "concat(' F', c_custkey) as FirstName",
            "concat(c_name, ' ') as LastName",
            """case when c_custkey % 7 = 0 then null
                 when c_custkey % 10 = 3 then concat('User', c_custkey - 1, '@D', c_custkey - 1, '.Example.com')
                 when c_custkey % 31 = 0 then concat('user', c_custkey, '@gmail.com')
                 else concat('  USER', c_custkey, '@d', c_custkey, '.EXAMPLE.com ') end as Email""",
            "concat('+44 ', c_custkey % 90 + 10, '-', c_custkey) as Phone",
            "case c_nationkey % 4 when 0 then ' CTO' when 1 then 'Buyer ' end as Title",
            "c_mktsegment as Department",
            "case when c_custkey % 11 <> 0 then cast(c_custkey % 120 as string) end as OwnerId",
            "'2023-02-01T00:00:00Z' as CreatedDate",
            "'2024-01-03T09:00:00Z' as SystemModstamp",
        )
        return self._with_older(now, LastName="'old'", Email="'old@example.com'", SystemModstamp="'2023-06-01T00:00:00Z'")

    @cached_property
    def landed_leads(self) -> DataFrame:
        return self.spread_source("lineitem").selectExpr(
            "concat(l_orderkey, '-', l_linenumber) as Id",
            "concat('F', l_suppkey, ' ') as FirstName",
            "concat(' L', l_partkey) as LastName",
            "concat('Company ', l_suppkey) as Company",
            "concat(' L', l_partkey, '@D', l_suppkey, '.example.com') as Email",
            "case l_returnflag when 'R' then ' Web' when 'A' then 'Partner ' end as LeadSource",
            "concat(l_linestatus, ' ') as Status",
            "case l_linenumber % 3 when 0 then 'Hot' when 1 then ' Warm' end as Rating",
            "cast(l_suppkey as string) as OwnerId",
            "case l_returnflag when 'R' then 'true' when 'A' then 'false' end as IsConverted",
            "case when l_returnflag = 'R' then cast(l_suppkey as string) end as ConvertedAccountId",
            "case when l_returnflag = 'R' then cast(l_partkey as string) end as ConvertedContactId",
            "case when l_returnflag = 'R' then cast(l_orderkey as string) end as ConvertedOpportunityId",
            "concat(cast(date_sub(cast(l_shipdate as date), cast(l_quantity as int)) as string), 'T00:00:00Z') as CreatedDate",
            "concat(cast(cast(l_shipdate as date) as string), 'T00:00:00Z') as SystemModstamp",
            "lpad(cast(l_partkey * 1000000 + l_suppkey as string), 20, '0') as _batch_id",
        )

    @cached_property
    def landed_opportunities(self) -> DataFrame:
        now = self.spread_source("orders").selectExpr(
            "cast(o_orderkey as string) as Id",
            "case when o_orderkey % 31 <> 0 then cast(o_custkey as string) end as AccountId",
            "concat(' Deal ', o_orderkey) as Name",
            "case o_orderstatus when 'F' then 'Closed Won' when 'P' then 'Closed Lost ' else ' Open' end as StageName",
            """case when o_orderkey % 13 = 0 then 'tbd'
                 else cast(cast(o_totalprice as decimal(18,2)) as string) end as Amount""",
            "cast(o_orderkey % 101 as string) as Probability",
            """case when o_orderkey % 37 = 0 then 'soon'
                 else cast(cast(o_orderdate as date) as string) end as CloseDate""",
            "o_orderpriority as Type",
            "case o_orderkey % 3 when 0 then 'Web ' when 1 then 'Partner' end as LeadSource",
            "case o_orderstatus when 'O' then null else 'true' end as IsClosed",
            "case o_orderstatus when 'F' then 'true' when 'P' then 'false' end as IsWon",
            "case when o_orderkey % 17 <> 0 then cast(o_orderkey % 120 as string) end as OwnerId",
            "'2023-03-01T00:00:00Z' as CreatedDate",
            "'2024-01-04T10:00:00Z' as SystemModstamp",
        )
        return self._with_older(now, StageName="'old'", Amount="'1.00'", SystemModstamp="'2023-06-01T00:00:00Z'")

    @cached_property
    def landed_roles(self) -> DataFrame:
        return self.spread_source("lineitem").selectExpr(
            "concat(l_orderkey, '-', l_linenumber) as Id",
            "case when l_linenumber <> 7 then cast(l_orderkey + l_partkey % 2 * 1000000 as string) end as OpportunityId",
            "case when l_partkey % 29 <> 0 then cast(l_partkey as string) end as ContactId",
            "case l_returnflag when 'R' then ' Decision Maker' when 'A' then 'Evaluator ' end as Role",
            "case l_linenumber when 1 then true when 2 then false end as IsPrimary",
            "concat(cast(date_sub(cast(l_shipdate as date), cast(l_quantity as int)) as string), 'T00:00:00Z') as CreatedDate",
            "concat(cast(cast(l_shipdate as date) as string), 'T00:00:00Z') as SystemModstamp",
            "lpad(cast(l_partkey * 1000000 + l_suppkey as string), 20, '0') as _batch_id",
        )

    @cached_property
    def messages(self) -> DataFrame:
        """Three JSON messages per event: an hour older, the same time at a lower offset, and the one that counts."""
        fields = self.spread_source("events").selectExpr(
            "event_id",
            f"{EVENT_TYPE} as event_type",
            "ts",
            f"{CUSTOMER} as cust",
            "cast(floor(value) as int) as seconds",
            "explode(array(0, 1, 2)) as copy",
        )
        # The second contact is greater than any other and has no account; some emails then need the account of a lesser one.
        text = {"sfdc_contact_id": "case when cust % 230 = 92 then concat('9', cust) when event_id % 100 = 57 then cust end",
                "sfdc_account_id": "case when event_id % 50 = 7 then cust end",
                "anonymous_id": "case when event_id % 20 <> 0 then concat('anon_', cust) end",
                "email": "case when event_id % 4 = 0 then concat(' USER', cust, '@d', cust, '.Example.com') end",
                "domain": """case event_id % 3 when 0 then concat('https://www.D', cust, '.example.com/x')
                                               when 1 then 'gmail.com' end"""}  # fmt: skip
        who = ", ".join(f"""concat('"{name}":"', {value}, '"')""" for name, value in text.items())
        return fields.selectExpr(
            f"""case when event_id % 37 = 0 and copy = 1 then '{{"event_id": "evt_' else concat(
                 '{{"event_id":"evt_', event_id,
                 '","event_type":"', case copy when 2 then event_type else 'website_visit' end,
                 '","timestamp":"', cast(ts - case copy when 0 then interval 1 hour else interval 0 hour end as string),
                 'Z","identity_resolution":{{', concat_ws(',', {who}),
                 '}},"attributes":{{"url":"https://example.com/', event_id % 10,
                 '","plan_interest":', case when event_type = 'pricing_page_view' then '"enterprise"' else 'null' end,
                 ',"duration_seconds":', seconds * copy, '}}}}') end as json_payload""",
            "event_id * 3 + copy as _kafka_offset",
            "cast(event_id % 8 as int) as _kafka_partition",
        )

    @cached_property
    def parsed_events(self) -> DataFrame:
        return parse_events(self.messages)

    @cached_property
    def landed_events(self) -> DataFrame:
        """The parsed messages as a written table, as the stream leaves them."""
        return stage(self.parsed_events, "landed_events")

    @cached_property
    def identity_events(self) -> DataFrame:
        """The columns of the landed events that identities are made of, for queries that read no others."""
        return stage(self.parsed_events.select("timestamp", "identity_resolution"), "identity_events")

    # Canonical tables from the landed ones.

    @cached_property
    def silver_accounts(self) -> DataFrame:
        return canonical(ACCOUNT, self.landed_accounts)

    @cached_property
    def silver_contacts(self) -> DataFrame:
        return canonical(CONTACT, self.landed_contacts)

    # The same as written tables, for queries that read them more than once.

    @cached_property
    def written_accounts(self) -> DataFrame:
        return stage(self.silver_accounts, "account")

    @cached_property
    def written_contacts(self) -> DataFrame:
        return stage(self.silver_contacts, "contact")

    @cached_property
    def silver_leads(self) -> DataFrame:
        return canonical(LEAD, self.landed_leads)

    @cached_property
    def silver_opportunities(self) -> DataFrame:
        return canonical(OPPORTUNITY, self.landed_opportunities)

    @cached_property
    def silver_roles(self) -> DataFrame:
        return canonical(OPPORTUNITY_CONTACT_ROLE, self.landed_roles)

    @cached_property
    def silver_reps(self) -> DataFrame:
        return canonical(SALES_REP, self.landed_users)
