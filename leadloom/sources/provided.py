"""The entities, derived from the provided star-schema tables.

Each entity is a projection of a whole table, so a scan keeps column pruning and
filter push-down. The expressions run unchanged on Spark and on DuckDB. They put in what
the plain tables lack: nulls, mixed spellings, blank identities, keys without a partner.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Entity:
    table: str
    columns: dict[str, str]
    where: str | None = None
    distinct: bool = False

    def select_list(self) -> list[str]:
        return [f"{expr} AS {name}" for name, expr in self.columns.items()]

    def sql(self) -> str:
        distinct = "DISTINCT " if self.distinct else ""
        where = f" WHERE {self.where}" if self.where else ""
        return f"SELECT {distinct}{', '.join(self.select_list())} FROM {self.table}{where}"


def _text(expr: str) -> str:
    return f"cast({expr} AS varchar(20))"


ENTITIES: dict[str, Entity] = {
    "crm_lead": Entity(
        "orders",
        {
            "id": "o_orderkey",
            "convertedaccountid": "o_custkey",
            "createddate": "o_orderdate",
            "lead_segment": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE cast(o_orderkey % 6 AS int) END",
            "pre_screen": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Green' WHEN '2-HIGH' THEN 'yellow ' "
            "WHEN '3-MEDIUM' THEN 'RED' WHEN '4-NOT SPECIFIED' THEN 'Blue (No Hit)' ELSE NULL END",
        },
    ),
    "crm_account": Entity(
        "customer",
        {
            "id": "c_custkey",
            "createddate": "cast(date '2019-01-01' + cast(c_custkey * 7 % 1000 AS int) * interval '1' day AS date)",
            "recordtypeid": "c_mktsegment",
            "model_tier": "CASE WHEN c_custkey % 5 = 0 THEN 'T1' END",
            "warranty_id": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END",
            "financing_result": "CASE WHEN c_acctbal < 0 THEN 'Declined' ELSE 'Approved' END",
            "lead_segment": "cast(c_custkey % 6 AS int)",
            "pre_screen": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Green' END",
            "dental_condition": "CASE WHEN c_nationkey % 4 = 0 THEN NULL "
            f"ELSE concat('Condition ', {_text('c_nationkey % 4')}) END",
            "distance_to_center": "c_acctbal",
        },
    ),
    # One fifth of the metric rows belongs to no lead, so those leads have none.
    "revenue": Entity(
        "lineitem",
        {
            "leadid": "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_orderkey END",
            "revenue_sold": "cast(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS decimal(18,2))",
        },
    ),
    "apt_history": Entity(
        "lineitem",
        {
            "id": "l_orderkey * 10 + l_linenumber",
            "lead_id": "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_orderkey END",
            "account_id": "CASE WHEN l_linenumber % 3 = 0 AND l_linenumber <> 6 THEN l_partkey % 1500 ELSE NULL END",
            "consultinventory_id": "l_orderkey * 10 + l_linenumber",
            "action": "CASE l_returnflag WHEN 'N' THEN 'Scheduled' WHEN 'R' THEN 'cancel' ELSE 'Completed' END",
            "createdbyid": "CASE WHEN l_suppkey % 11 = 0 THEN -1 ELSE l_suppkey END",
            "createddate": "l_shipdate",
        },
    ),
    "completes": Entity(
        "lineitem",
        {"lead_id": "l_orderkey", "consultinventory_id": "l_orderkey * 10 + l_linenumber"},
        where="l_linestatus = 'F'",
    ),
    # A null account, and accounts outside the account table (negative ids), so that
    # some accounts are only known from treatment plans.
    "quote": Entity(
        "orders",
        {
            "id": "o_orderkey",
            "accountid": "CASE WHEN o_custkey % 50 = 1 THEN NULL WHEN o_custkey % 2 = 1 THEN o_custkey "
            "ELSE -1 - o_custkey END",
            "price": "cast(o_totalprice AS decimal(18,2))",
        },
    ),
    "quote_line": Entity("lineitem", {"quoteid": "l_orderkey", "product2id": "l_partkey"}),
    "product": Entity("part", {"id": "p_partkey", "legacytreatmentoption": "p_partkey % 100"}),
    "treatment_option": Entity(
        "nation",
        {
            "id": "cast(n_nationkey AS bigint)",
            "treatment_class": "CASE WHEN n_regionkey = 0 THEN 'Double Arch' ELSE 'Single Arch' END",
            "treatment_grade": "CASE n_nationkey % 6 WHEN 0 THEN 'Non-Arch' WHEN 1 THEN 'Zirconia' "
            "WHEN 2 THEN 'Hybrid' WHEN 3 THEN 'PHASED' WHEN 4 THEN 'Sinus' ELSE NULL END",
        },
    ),
    "treatment_plan": Entity(
        "orders",
        {
            "account": "CASE WHEN o_custkey % 40 = 3 THEN NULL ELSE o_custkey END",
            "treatment_option": "CASE WHEN o_orderkey % 31 = 30 THEN NULL ELSE o_orderkey % 30 END",
            "initial_cost": "cast(o_totalprice AS decimal(18,2))",
        },
    ),
    "esi": Entity(
        "events",
        {
            "lead": "CASE WHEN event_type = 'click' THEN NULL ELSE event_id % 5000 END",
            "esi": "cast(event_id % 23 AS int)",
        },
    ),
    "consult": Entity(
        "lineitem",
        {
            "id": "l_orderkey * 10 + l_linenumber",
            "scheduled_lead": "CASE WHEN l_linenumber % 2 = 1 THEN l_orderkey END",
            "scheduled_account": "CASE WHEN l_linenumber % 2 = 0 AND l_linenumber <> 6 THEN l_partkey % 1500 END",
            "scheduled_by": "CASE WHEN l_suppkey % 11 = 0 THEN -1 ELSE l_suppkey END",
            "apt_date": "cast(l_shipdate AS date)",
            "apt_datetime": "l_shipdate + (8 + l_partkey % 9) * interval '1' hour",
            "start_hour": "cast(8 + l_partkey % 9 AS int)",
            "arrival_time": "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_shipdate END",
            "active": "l_linestatus = 'F'",
            "consult_room": "l_suppkey % 30",
            "color": "CASE l_linenumber WHEN 1 THEN 'Network Purple' WHEN 2 THEN NULL ELSE 'green' END",
        },
    ),
    "consult_room": Entity(
        "nation",
        {
            "id": "cast(n_nationkey AS bigint)",
            "name": "n_name",
            "room_type": "CASE WHEN n_nationkey % 5 = 0 THEN 'Practice' WHEN n_nationkey % 7 = 0 THEN NULL "
            "ELSE 'Normal' END",
            "center_information": "cast(n_regionkey AS bigint)",
        },
    ),
    "center": Entity(
        "region",
        {"id": "cast(r_regionkey AS bigint)", "name": "r_name", "use_ibs": "r_regionkey % 2 = 0"},
    ),
    "agent": Entity("supplier", {"id": "s_suppkey", "name": f"concat('Agent ', {_text('s_suppkey % 40')})"}),
    # The media week of the 13th of each month is not filled in.
    "calendar": Entity(
        "lineitem",
        {
            "actual_date": "cast(l_shipdate AS date)",
            "media_week": "CASE WHEN day(l_shipdate) = 13 THEN NULL "
            "ELSE cast(date_trunc('week', l_shipdate) AS date) END",
            "media_month": "cast(date_trunc('month', l_shipdate) AS date)",
        },
        distinct=True,
    ),
    "mkt_lead": Entity(
        "orders",
        {
            "id": "o_orderkey",
            "lead_date": "cast(o_orderdate AS date)",
            "media_week": "cast(date_trunc('week', o_orderdate) AS date)",
            "media_month": "cast(date_trunc('month', o_orderdate) AS date)",
            "center": f"CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE concat('Center ', {_text('o_custkey % 4')}) END",
            "in_market": "CASE WHEN o_custkey % 3 = 0 THEN 'N' ELSE 'Y' END",
            "pre_screen": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Green' WHEN '2-HIGH' THEN 'yellow' "
            "WHEN '3-MEDIUM' THEN 'Red' WHEN '4-NOT SPECIFIED' THEN 'Blue (No Hit)' ELSE NULL END",
            "created_by_name": "CASE o_orderstatus WHEN 'F' THEN 'Website API' WHEN 'O' THEN 'IMC API' "
            "ELSE 'somebody' END",
            "lead_type": "CASE WHEN o_custkey % 9 = 0 THEN 'Partial' ELSE 'Traditional' END",
            "first_creative_id": "o_custkey % 120",
            "first_name": f"concat(CASE WHEN o_orderkey % 2 = 0 THEN 'F' ELSE 'f' END, {_text('o_custkey % 40')})",
            "last_name": f"CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE concat('L', {_text('o_custkey')}) END",
            "street": "CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE '' END",
            "phone": f"CASE WHEN o_orderkey % 3 = 0 THEN {_text('o_orderkey')} END",
            "postal_code": f"CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE concat('Z', {_text('o_custkey % 10')}) END",
            "email": f"CASE WHEN o_custkey % 2 = 0 THEN concat('u', {_text('o_custkey')}, '@x') END",
        },
    ),
    "campaign": Entity(
        "supplier",
        {
            "id": "s_suppkey",
            "phone_number": f"concat('555-', {_text('s_suppkey % 20')})",
            "media": "CASE WHEN s_suppkey % 8 = 0 THEN 'Per Inquiry' WHEN s_suppkey % 3 = 0 THEN 'TV' END",
            "agency": "CASE WHEN s_suppkey % 9 = 1 THEN 'CPM Network' END",
            "type": "CASE s_suppkey % 5 WHEN 0 THEN 'National' WHEN 1 THEN 'TV' WHEN 2 THEN 'Web-Display' "
            "WHEN 3 THEN 'Web-SEM' END",
        },
    ),
    "mkt_info": Entity(
        "lineitem",
        {
            "leadid": "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_orderkey END",
            "first_creative_name": f"concat('Cr', {_text('l_suppkey % 5')})",
            "first_media_outlet": f"concat('Out', {_text('l_suppkey % 3')})",
            "first_campaign_name": "CASE WHEN l_suppkey % 4 = 0 THEN NULL "
            f"ELSE concat('Camp', {_text('l_suppkey % 4')}) END",
            "last_campaign_name": f"concat('Camp', {_text('l_partkey % 3')})",
            "dma_id": "l_suppkey % 30",
            "num_consult_appointments": "l_linenumber",
            "num_consult_completed": "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END",
            "net_num_starts": "CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'R' THEN NULL ELSE 0 END",
            "revenue_sold": "cast(l_extendedprice * 2 AS decimal(18,2))",
            "revenue_cancelled": "CASE WHEN l_returnflag = 'R' THEN cast(l_extendedprice AS decimal(18,2)) END",
            "collected": "CASE WHEN l_linenumber = 2 THEN NULL ELSE cast(l_extendedprice AS decimal(18,2)) END",
            "refunded": "CASE WHEN l_returnflag = 'R' THEN cast(l_tax * 1000 AS decimal(18,2)) END",
        },
    ),
    "dma": Entity("nation", {"id": "cast(n_nationkey AS bigint)", "name": "n_name"}),
}


_STORED_SCHEMAS: dict[tuple, StructType] = {}


class Entities:
    """The entities of one data folder: ``Entities(spark, folder).crm_lead``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        """A stored table. Its schema is looked up in the files once, and again when they change."""
        path = f"{self.folder}/{name}.parquet"
        stored = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        status = stored.getFileSystem(self.spark._jsc.hadoopConfiguration()).getFileStatus(stored)
        version = (path, status.getModificationTime(), status.getLen())
        if version not in _STORED_SCHEMAS:
            _STORED_SCHEMAS[version] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_STORED_SCHEMAS[version]).parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in ENTITIES:
            raise AttributeError(name)
        entity = ENTITIES[name]
        df = self.table(entity.table)
        if entity.where:
            df = df.where(entity.where)
        df = df.selectExpr(*entity.select_list())
        return df.distinct() if entity.distinct else df


def view_sql(name: str) -> str:
    """The entity as a query text for an engine that knows the tables by name."""
    return ENTITIES[name].sql()
