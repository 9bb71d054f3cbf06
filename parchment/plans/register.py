"""Register-like tables made from the driver's tables, since those hold no registers.

``PAGES`` makes pages from orders: six lines a record, fourteen lines a page, so that records run
over page breaks. ``PEOPLE``, ``RELATIONS``, ``EVENTS`` and ``PRINCIPALS`` make extracted records from
customers: an entry each, three people, with flaws planted by arithmetic on the key. Both Spark and
DuckDB run these texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import table

LINES = """
SELECT o_custkey % 97 AS volume, o_orderkey AS k, n, CASE n
  WHEN 1 THEN CASE WHEN o_orderkey % 9 = 0 THEN 'Maria' ELSE '' END
  WHEN 2 THEN CASE WHEN o_orderkey % 7 = 0 THEN 'Lunes, dia tres de Mayo' WHEN o_orderkey % 5 = 0 THEN 'En dies y seis de Noviem'
    WHEN o_orderkey % 11 = 0 THEN 'El dia quinze de Julio de mil ochocientos' ELSE 'Pedro Aos vinte e dous de Março de 1793' END
  WHEN 3 THEN CASE WHEN o_orderkey % 5 = 0 THEN '=bre de mil setecientos bautice a un niño que na-' ELSE 'bautice y puse los santos oleos a un niño que na-' END
  WHEN 4 THEN '-cio el dia quinze de Junio, hijo legitimo de Juan ' || CAST(o_custkey AS STRING) || ' y de'
  WHEN 5 THEN CASE WHEN o_orderkey % 6 = 0 THEN 'Ana Gomez, fueron sus padrinos los dichos vecinos' ELSE 'Ana Gomez su mujer, y para que conste lo firmé' END
  ELSE CASE WHEN o_orderkey % 4 = 0 THEN '47..' ELSE 'Fr. Juan de la Cruz' END END AS line
FROM {orders} CROSS JOIN (SELECT 1 AS n UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5 UNION ALL SELECT 6) AS numbers
"""
PAGES = f"""
SELECT volume, page_no, concat('v', CAST(volume AS STRING), '-', lpad(CAST(page_no AS STRING), 4, '0'), '.jpg') AS image,
  CASE WHEN page_no % 23 = 0 THEN '[transcription failed: max retries reached]'
    ELSE array_join(transform(array_sort(collect_list(struct(at, line))), x -> x.line), chr(10)) END AS text
FROM (SELECT volume, line, row_number() OVER (PARTITION BY volume ORDER BY k, n) AS at, floor((row_number() OVER (PARTITION BY volume ORDER BY k, n) - 1) / 14) + 1 AS page_no FROM ({LINES}))
GROUP BY volume, page_no
"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """volume, page_no, image, text; dealt evenly, since a page costs more time than its bytes suggest."""
    made = spark.sql(PAGES, orders=table(spark, sf_dir, "orders"))
    return made.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "volume", "page_no")




def _name(h: str) -> str:
    """Both engines divide whole numbers differently, so that the text does it by subtraction of remainders."""
    ten, hundred = f"CAST((({h}) - ({h}) % 10) / 10 AS BIGINT)", f"CAST((({h}) - ({h}) % 100) / 100 AS BIGINT)"
    part = lambda letters, width, of: f"substr('{letters}', CAST({width} * (({of}) % {len(letters) // width}) + 1 AS INT), {width})"
    return f"concat({part('JuMaRoViBiCaKaGoLuPe', 2, h)}, {part('anriszlobevesamodina', 2, ten)}, {part('aoeiz', 1, hundred)})"


_GIVEN, _SURNAME = _name("k * 7919 % 503"), _name("k * 104729 % 907 + 11")
#: volume, entry (page and number), ord (order of entries in a volume) of a customer k.
_ENTRY = "c_nationkey AS volume, concat(lpad(CAST(CAST((k - k % 4) / 4 AS BIGINT) AS STRING), 6, '0'), '-0', CAST(k % 4 + 1 AS STRING)) AS entry, k AS ord"
_CUSTOMERS = "(SELECT c_custkey AS k, c_nationkey FROM {customer}) AS c"
_ATTRIBUTES = """CASE WHEN k % 3 = 0 THEN NULL WHEN k % 7 = 0 THEN 'Parda ' ELSE 'morena' END AS phenotype, CASE WHEN (k + p) % 5 = 0 THEN 'true' WHEN (k + p) % 5 = 1 THEN 'false' END AS free,
  CASE WHEN k % 6 = 0 THEN ' Congo' WHEN k % 6 = 1 THEN '' WHEN k % 6 = 2 THEN 'criollo' END AS origin, CASE WHEN (k + p) % 10 = 3 THEN 'carpenter' WHEN p = 3 THEN 'priest' END AS occupation,
  CASE WHEN k % 9 = 1 THEN 'adult' WHEN k % 9 = 2 THEN '3 dias' WHEN k % 9 = 3 THEN 'infant' END AS age"""

PEOPLE = f"""
SELECT volume, entry, ord, p AS pos, concat('P0', CAST(p AS STRING)) AS id, name, phenotype, free, origin, occupation, age FROM (
  SELECT {_ENTRY}, 1 AS p, CASE WHEN k % 29 = 0 THEN {_GIVEN} ELSE concat({_GIVEN}, ' ', {_SURNAME}) END AS name, {_ATTRIBUTES.replace("(k + p)", "(k + 1)").replace("p = 3", "1 = 3")} FROM {_CUSTOMERS} WHERE k % 37 <> 0
  UNION ALL SELECT {_ENTRY}, 2 AS p, concat('Doña ', {_name("k * 31 % 97")}, ' ', {_SURNAME}) AS name, {_ATTRIBUTES.replace("(k + p)", "(k + 2)").replace("p = 3", "2 = 3")} FROM {_CUSTOMERS} WHERE k % 37 <> 0
  UNION ALL SELECT {_ENTRY}, 3 AS p, concat('Fray ', {_name("k % 13 + 200")}, ' Gómez') AS name, {_ATTRIBUTES.replace("(k + p)", "(k + 3)").replace("p = 3", "3 = 3")} FROM {_CUSTOMERS} WHERE k % 37 <> 0) AS people
"""
RELATIONS = f"""
SELECT {_ENTRY}, 'P01' AS id, 1 AS pos, CASE WHEN k % 11 = 0 THEN 'P09' ELSE 'P02' END AS related_person, 'child' AS relationship_type FROM {_CUSTOMERS} WHERE k % 37 <> 0
UNION ALL SELECT {_ENTRY}, 'P02' AS id, 1 AS pos, 'P01' AS related_person, CASE WHEN k % 8 = 0 THEN 'child' WHEN k % 15 = 0 THEN 'spouse' ELSE 'parent' END AS relationship_type FROM {_CUSTOMERS} WHERE k % 37 <> 0
UNION ALL SELECT {_ENTRY}, 'P03' AS id, 1 AS pos, 'P01' AS related_person, CASE WHEN k % 10 = 0 THEN 'confessor' WHEN k % 21 = 0 THEN 'witness' ELSE 'godparent' END AS relationship_type FROM {_CUSTOMERS} WHERE k % 37 <> 0
UNION ALL SELECT {_ENTRY}, 'P01' AS id, 2 AS pos, 'P03' AS related_person, 'godchild' AS relationship_type FROM {_CUSTOMERS} WHERE k % 37 <> 0 AND k % 5 <> 0
"""
EVENTS = f"""
SELECT {_ENTRY}, 1 AS pos, CASE WHEN k % 7 = 0 THEN 'marriage' WHEN k % 13 = 0 THEN 'Burial' ELSE 'baptism' END AS type,
  CASE WHEN k % 19 = 0 THEN '1799-02-31' WHEN k % 17 = 0 THEN '1801-05' WHEN k % 41 = 0 THEN NULL ELSE concat(CAST(CAST(1700 + (k % 3000 - k % 30) / 30 + k % 9 - k % 2 AS INT) AS STRING), '-0', CAST(k % 9 + 1 AS STRING), '-', lpad(CAST(k % 28 + 1 AS STRING), 2, '0')) END AS date
FROM {_CUSTOMERS}
"""
PRINCIPALS = f"""
SELECT {_ENTRY}, 1 AS event, 1 AS pos, 'P01' AS id FROM {_CUSTOMERS} WHERE k % 23 <> 0
UNION ALL SELECT {_ENTRY}, 1 AS event, 2 AS pos, CASE WHEN k % 14 = 0 THEN 'P07' ELSE 'P02' END AS id FROM {_CUSTOMERS} WHERE k % 7 = 0 OR k % 20 = 0
"""
TABLES = {"people": PEOPLE, "relations": RELATIONS, "events": EVENTS, "principals": PRINCIPALS}


def register(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """people, relations, events and principals of entries, one entry a customer."""
    customer = table(spark, sf_dir, "customer")
    return {name: spark.sql(sql, customer=customer) for name, sql in TABLES.items()}


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """volume, entry and ord of all entries, those without people too."""
    return spark.sql(f"SELECT {_ENTRY} FROM {_CUSTOMERS}", customer=table(spark, sf_dir, "customer"))


#: The same tables as the start of a DuckDB query.
WITH = "WITH " + ",\n".join(f"{name} AS ({sql.format(customer='customer')})" for name, sql in (TABLES | {"entries": f"SELECT {_ENTRY} FROM {_CUSTOMERS}"}).items())
