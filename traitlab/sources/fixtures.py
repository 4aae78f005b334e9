"""Input views of the attribute jobs, derived from the driver tables.

The jobs read an item catalog, per-device install lists, account records,
a device relation, questionnaire answers and a child-stage table. The test
driver only ships TPC-H-like tables, documents and labels, so each input is
derived from them by a fixed SQL recipe. Each recipe is one text with
``{table}`` placeholders: Spark receives DataFrames for them, the DuckDB
oracle receives plain view names, so both engines evaluate the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import constants as C
from .tables import TableSet

JOB_DATE = 20180709

# recipe name -> (placeholders it reads, Spark SQL text, DuckDB SQL text or None for "same")
_RECIPES: dict[str, tuple[tuple[str, ...], str, str | None]] = {}


def _recipe(name: str, reads: tuple[str, ...], spark_sql: str,
            duck_sql: str | None = None) -> None:
    _RECIPES[name] = (reads, spark_sql, duck_sql)


_recipe("app_catalog", ("part", "lineitem"), """
select cast(p_partkey as string) as appid,
  case when p_partkey % 50 = 7 then null
       else p_name || (case l_returnflag when 'A' then '' when 'N' then ' lite' else ':pro' end) end as app_name,
  count(*) as installnum, case when p_partkey % 10 = 9 then 20180708 else 20180709 end as stat_date
from {part} join {lineitem} on p_partkey = l_partkey
group by p_partkey, p_name, l_returnflag
""")

_recipe("users_info", ("customer",), """
select c_custkey as user_id, c_nationkey % 3 as sex,
  case when c_custkey % 23 = 0 then null when c_custkey % 17 = 0 then ''
       else cast(1935 + c_custkey % 80 as string) || '-01-01' end as birthdate,
  20180709 as stat_date
from {customer}
union all
select c_custkey as user_id, (c_nationkey + 1) % 3 as sex, '1990-01-01' as birthdate, 20180708 as stat_date
from {customer}
""")

_recipe("device_rel", ("customer",), """
select c_custkey as uid,
  case when c_custkey % 41 = 0 then null
       else cast(c_custkey - (case when c_custkey % 5 = 4 then 1 else 0 end) as string) end as device_id,
  20180709 as stat_date
from {customer}
union all
select c_custkey as uid, cast(c_custkey + 1 as string) as device_id, 20180708 as stat_date
from {customer}
""")

# The age labels have a device relation of their own, which shares other devices.
_recipe("age_device_rel", ("customer",), """
select c_custkey as uid,
  case when c_custkey % 43 = 0 then null
       else cast(c_custkey - (case when c_custkey % 5 = 3 then 1 else 0 end) as string) end as device_id,
  20180709 as stat_date
from {customer}
union all
select c_custkey as uid, cast(c_custkey + 2 as string) as device_id, 20180708 as stat_date
from {customer}
""")

_recipe("questionnaire", ("customer",), """
select cast(c_custkey - (case when c_custkey % 5 = 4 then 1 else 0 end) as string) as device_id,
  substr('ABCDEFGH', cast(1 + c_custkey % 8 as int), 1) as q3,
  substr('ABCDE', cast(1 + c_custkey % 5 as int), 1) as q4,
  substr('ABCDEFGHIJQL', cast(1 + c_custkey % 12 as int), 1) as q6,
  case when c_custkey % 9 = 0 then '' when c_custkey % 9 = 1 then 'AB'
       else substr('ABCDEFGH', cast(1 + c_custkey % 8 as int), 1) end as q7,
  case when c_custkey % 7 = 0 then '' else substr('ABC', cast(1 + c_custkey % 3 as int), 1) end as q8,
  case when c_custkey % 7 = 1 then null else substr('ABC', cast(1 + c_custkey % 3 as int), 1) end as q9,
  case when c_custkey % 7 = 2 then '' else substr('ABCDE', cast(1 + c_nationkey % 5 as int), 1) end as q10,
  case when c_custkey % 7 = 3 then '' else substr('ABCD', cast(1 + c_nationkey % 4 as int), 1) end as q11
from {customer}
""")

_recipe("child_stage", ("customer",), """
select cast(c_custkey - (case when c_custkey % 5 = 4 then 1 else 0 end) as string) as device_id,
  case c_custkey % 5 when 0 then '婴幼儿' when 1 then '孕育期' when 2 then '青少年' when 3 then '其他' end as child_stage
from {customer}
""")

_recipe("age_collect", ("customer",), """
select cast(c_custkey - (case when c_custkey % 5 = 4 then 1 else 0 end) as string) as device_id,
  c_name as src, cast(20 + c_nationkey as string) as age, 20180709 as stat_date
from {customer}
union all
select cast(c_custkey as string) as device_id, c_name as src, '90' as age, 20180708 as stat_date
from {customer}
""")

_recipe("scored", ("customer",), """
select c_custkey as id, (c_acctbal + 1000.0e0) / 11000.0e0 as score,
  case when c_nationkey % 2 = 0 then 1.0e0 else 0.0e0 end as label
from {customer}
""")

_INSTALLS_SPARK = """
select device_id,
  concat_ws(' ', transform(sort_array(collect_set(l_partkey)), x -> concat('{prefix}', cast(x as string), ':1'))) as value,
  20180709 as stat_date
from (select cast(o_custkey - (case when o_custkey % 5 = 4 then 1 else 0 end) as string) as device_id, l_partkey
      from {orders} join {lineitem} on o_orderkey = l_orderkey) t
group by device_id
union all
select distinct cast(o_custkey as string) as device_id, '{prefix}1:1' as value, 20180708 as stat_date from {orders}
"""

_INSTALLS_DUCK = """
select device_id,
  string_agg('{prefix}' || cast(l_partkey as string) || ':1', ' ' order by l_partkey) as value,
  20180709 as stat_date
from (select distinct cast(o_custkey - (case when o_custkey % 5 = 4 then 1 else 0 end) as string) as device_id, l_partkey
      from {orders} join {lineitem} on o_orderkey = l_orderkey) t
group by device_id
union all
select distinct cast(o_custkey as string) as device_id, '{prefix}1:1' as value, 20180708 as stat_date from {orders}
"""

# A second snapshot of a table carries other values, which the dated scan leaves out.
_recipe("user_installs", ("orders", "lineitem"),
        _INSTALLS_SPARK.replace("{prefix}", "11"),
        _INSTALLS_DUCK.replace("{prefix}", "11"))
_recipe("user_installs_push", ("orders", "lineitem"),
        _INSTALLS_SPARK.replace("{prefix}", ""),
        _INSTALLS_DUCK.replace("{prefix}", ""))

# Documents play devices: the distinct lower-case words of a text are its
# "installed items", and the labels table is the partially known attribute.
_recipe("doc_items", ("documents",), """
select device_id, case when size(w) > 0 then concat(array_join(w, ':1 '), ':1') else '' end as value,
  20180709 as stat_date
from (select cast(doc_id as string) as device_id,
             array_distinct(array_remove(split(lower(text), '[^\\\\pL]+'), '')) as w
      from {documents}) t
""", """
select cast(doc_id as string) as device_id,
  array_to_string(list_transform(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\pL]+'), lambda w: w <> '')),
                           lambda w: w || ':1'), ' ') as value,
  20180709 as stat_date
from {documents}
""")

_recipe("doc_catalog", ("documents",), """
select w as appid, w as app_name, count(*) as installnum, 20180709 as stat_date
from (select explode(array_distinct(array_remove(split(lower(text), '[^\\\\pL]+'), ''))) as w from {documents}) t
group by w
""", """
select w as appid, w as app_name, count(*) as installnum, 20180709 as stat_date
from (select unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\pL]+'), lambda w: w <> ''))) as w
      from {documents}) t
group by w
""")

_recipe("doc_labels", ("labels",), """
select cast(doc_id as string) as device_id, cast(quality as double) as label from {labels}
""")

_recipe("doc_labels_toxic", ("labels",), """
select cast(doc_id as string) as device_id, cast(toxic as double) as label from {labels}
""")

FIXTURE_NAMES = tuple(_RECIPES)


# The join keys of recipes that collect the joined rows into lists: merged shuffle
# partitions (sized by compressed bytes) would be sorted there beyond a task's memory.
_JOIN_KEYS = {"user_installs": {"orders": "o_orderkey", "lineitem": "l_orderkey"},
              "user_installs_push": {"orders": "o_orderkey", "lineitem": "l_orderkey"}}


def _dealt_out(tables: TableSet, name: str, rows_per_partition: int) -> dict[str, DataFrame]:
    """The tables a recipe reads; those of a large join by its key, in partitions
    that hold about ``rows_per_partition`` rows (a count reads file footers only)."""
    read = {t: tables.table(t) for t in _RECIPES[name][0]}
    keys = _JOIN_KEYS.get(name, {})
    n = max((-(-read[t].count() // rows_per_partition) for t in keys), default=1)
    if n > 1:
        n = max(n, tables.spark.sparkContext.defaultParallelism)
        read.update({t: read[t].repartition(n, k) for t, k in keys.items()})
    return read


def fixture(tables: TableSet, name: str, rows_per_partition: int = C.JOIN_ROWS_PER_PARTITION) -> DataFrame:
    """The Spark DataFrame of one derived input view."""
    return tables.spark.sql(_RECIPES[name][1], **_dealt_out(tables, name, rows_per_partition))


def duck_fixture_sql(name: str) -> str:
    """The DuckDB text of one derived input view (driver tables by name)."""
    reads, spark_sql, duck_sql = _RECIPES[name]
    text = duck_sql if duck_sql is not None else spark_sql
    for t in reads:
        text = text.replace("{" + t + "}", t)
    return text.strip()


def duck_with(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """A DuckDB ``WITH`` prefix defining the named views, then ``extra`` ones."""
    parts = [f"{n} AS ({duck_fixture_sql(n)})" for n in names]
    parts += [f"{n} AS ({sql.strip()})" for n, sql in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


class Fixtures:
    """Per-sf access to all derived views, each built once per instance."""

    def __init__(self, tables: TableSet):
        self.tables = tables
        self._cache: dict[str, DataFrame] = {}

    @property
    def spark(self):
        return self.tables.spark

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = fixture(self.tables, name)
        return self._cache[name]
