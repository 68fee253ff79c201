"""Restaurant tables as projections of the star-schema test tables.

Each property is a lazy DataFrame; nothing is read until a query runs.  Joins of two tables that grow are named as
merge joins: by the size of its file one of them would be broadcast, through the driver.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession


# Declared column types, so that opening a table reads no file footer.
_ESQUEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


class Dominio:
    def __init__(self, spark: SparkSession, carpeta: str):
        self.spark = spark
        self.carpeta = carpeta

    def tabla(self, nombre: str) -> DataFrame:
        return self.spark.read.schema(_ESQUEMAS[nombre]).parquet(f"{self.carpeta}/{nombre}.parquet")

    def _sql(self, texto: str, **tablas: DataFrame) -> DataFrame:
        return self.spark.sql(texto, **tablas)

    @cached_property
    def usuarios(self) -> DataFrame:
        return self._sql(
            """SELECT c_custkey AS id, c_name AS email, c_mktsegment AS rol, n_name AS ciudad,
                      r_name AS pais, CAST(18 + c_custkey % 60 AS INT) AS edad
               FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
               JOIN {region} ON n_regionkey = r_regionkey""",
            customer=self.tabla("customer"), nation=self.tabla("nation"), region=self.tabla("region"))

    @cached_property
    def restaurantes(self) -> DataFrame:
        return self._sql(
            """SELECT s_suppkey AS id, s_name AS nombre, n_name AS ciudad,
                      CAST(20 + s_suppkey % 81 AS INT) AS capacidad,
                      CASE s_suppkey % 3 WHEN 0 THEN 'gourmet' WHEN 1 THEN 'fast-food'
                           ELSE 'casual' END AS categoria_local,
                      CAST(984033 + 100 * (s_suppkey % 40) AS DOUBLE) / 100000 AS lat,
                      CAST(-8394037 + 100 * ((s_suppkey * 7) % 48) AS DOUBLE) / 100000 AS lon
               FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
            supplier=self.tabla("supplier"), nation=self.tabla("nation"))

    @cached_property
    def menus(self) -> DataFrame:
        return self._sql(
            """SELECT p_partkey AS id, p_name AS titulo, p_type AS categoria,
                      p_size % 2 = 0 AS activo,
                      p_partkey % (SELECT COUNT(*) FROM {supplier}) AS restaurante_id
               FROM {part}""",
            part=self.tabla("part"), supplier=self.tabla("supplier"))

    @cached_property
    def pedido_detalle(self) -> DataFrame:
        return self._sql(
            """SELECT l_orderkey AS pedido_id, l_partkey AS producto_id,
                      CAST(l_quantity AS INT) AS cantidad, l_extendedprice AS subtotal,
                      l_extendedprice / l_quantity AS precio_unitario
               FROM {lineitem}""",
            lineitem=self.tabla("lineitem"))

    @cached_property
    def pedidos_cabecera(self) -> DataFrame:
        """Orders without the columns that come from the lines (no scan of the lines)."""
        return self._sql(
            """SELECT o_orderkey AS id, o_custkey AS usuario_id, o_totalprice AS total,
                      CASE o_orderstatus WHEN 'F' THEN 'completado' WHEN 'O' THEN 'cancelado'
                           ELSE 'pendiente' END AS estado,
                      o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT)) AS fecha_creacion
               FROM {orders}""",
            orders=self.tabla("orders"))

    @cached_property
    def pedidos(self) -> DataFrame:
        return self._sql(
            """SELECT p.*, menu_id, restaurante_id, cantidad
               FROM {cab} p LEFT JOIN (
                 SELECT l_orderkey, MIN(l_partkey) AS menu_id, MIN(l_suppkey) AS restaurante_id,
                        CAST(SUM(l_quantity) AS BIGINT) AS cantidad
                 FROM {lineitem} GROUP BY l_orderkey) x ON l_orderkey = p.id""",
            cab=self.pedidos_cabecera, lineitem=self.tabla("lineitem"))

    def _reservas(self, columnas_linea: str, eventos: DataFrame, pedidos: DataFrame) -> DataFrame:
        return self._sql(
            f"""SELECT 1000000000 + event_id AS id, user_id AS usuario_id,
                      CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id END AS pedido_id,
                      CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS timestamp_reserva,
                      CASE event_type WHEN 'purchase' THEN 'ACTIVE' WHEN 'view' THEN 'ACTIVE'
                           WHEN 'error' THEN 'CANCELLED' ELSE 'PENDING' END AS estado,
                      CAST(1 + CAST(get_json_object(props, '$.k') AS INT) % 10 AS INT) AS invitados
                      {columnas_linea}
               FROM {{eventos}}
               UNION ALL
               SELECT id, usuario_id, id, fecha_creacion,
                      CASE WHEN id % 4 = 0 THEN 'CANCELLED' ELSE 'ACTIVE' END,
                      CAST(1 + id % 10 AS INT) {columnas_linea}
               FROM {{pedidos}} WHERE id % 5 <> 0""",
            eventos=eventos, pedidos=pedidos)

    @cached_property
    def reservas(self) -> DataFrame:
        de_pedido = self.pedidos.selectExpr("id AS event_id", "menu_id", "restaurante_id")
        eventos = self.tabla("events").join(de_pedido, "event_id", "left")
        return self._reservas(", menu_id, restaurante_id", eventos, self.pedidos)

    @cached_property
    def reservas_cabecera(self) -> DataFrame:
        """Reservations without the menu and restaurant of their order (no scan of the lines)."""
        return self._reservas("", self.tabla("events"), self.pedidos_cabecera)

    @cached_property
    def recomienda(self) -> DataFrame:
        return self._sql(
            """SELECT src, dst, canal, date_add(DATE '2024-01-01', CAST(src % 365 AS INT)) AS fecha FROM (
                 SELECT c_custkey AS src, (c_custkey * 7 + 3) % (SELECT COUNT(*) FROM {customer}) AS dst,
                        CASE c_custkey % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'app' ELSE 'social' END AS canal
                 FROM {customer}
                 UNION ALL
                 SELECT (c_custkey * 7 + 3) % (SELECT COUNT(*) FROM {customer}), c_custkey, 'app'
                 FROM {customer} WHERE c_custkey % 3 = 0) e
               WHERE src <> dst""",
            customer=self.tabla("customer"))

    @cached_property
    def calle(self) -> DataFrame:
        return self._sql(
            """SELECT c_custkey AS id, CAST(98400 + 10 * (c_custkey % 40) AS DOUBLE) / 10000 AS lat,
                      CAST(-839400 + 10 * CAST(FLOOR(c_custkey / 40) AS BIGINT) AS DOUBLE) / 10000 AS lon
               FROM {customer}""",
            customer=self.tabla("customer"))

    @cached_property
    def road(self) -> DataFrame:
        """Stored in one direction; a third of the segments lack a name (NULL or empty)."""
        return self._sql(
            """SELECT src, dst, distancia,
                      CASE src % 6 WHEN 0 THEN NULL WHEN 1 THEN ''
                           ELSE concat('Calle ', CAST(src % 23 AS STRING)) END AS nombre
               FROM (SELECT /*+ MERGE(b) */ a.id AS src, b.id AS dst, CAST(100 + (a.id * 37) % 50 AS DOUBLE) AS distancia
                     FROM {calle} a JOIN {calle} b ON b.id = a.id + 1 WHERE a.id % 40 < 39
                     UNION ALL
                     SELECT /*+ MERGE(b) */ a.id, b.id, CAST(100 + (a.id * 53) % 50 AS DOUBLE)
                     FROM {calle} a JOIN {calle} b ON b.id = a.id + 40) e""",
            calle=self.calle)

    # ---- delivery side: couriers at restaurants, customers at their road node -------------

    @cached_property
    def clientes(self) -> DataFrame:
        return self._sql(
            """SELECT /*+ MERGE(c) */ u.id, u.email, c.lat + CAST(u.id % 5 AS DOUBLE) / 100000 AS lat,
                      c.lon - CAST(u.id % 3 AS DOUBLE) / 100000 AS lon
               FROM {usuarios} u JOIN {calle} c ON c.id = u.id""",
            usuarios=self.usuarios, calle=self.calle)

    @cached_property
    def repartidores(self) -> DataFrame:
        return self._sql(
            """SELECT id, ciudad AS zona, lat, lon, id % 7 <> 3 AS activo,
                      CAST(3 + id % 5 AS INT) AS capacidad_max,
                      CAST(20 + id % 11 AS DOUBLE) AS velocidad_promedio,
                      CAST(id % 3 AS INT) AS carga
               FROM {restaurantes}""",
            restaurantes=self.restaurantes)

    @cached_property
    def pedidos_entrega(self) -> DataFrame:
        return self._sql(
            """SELECT p.id, p.usuario_id AS cliente_id, p.restaurante_id, r.ciudad AS zona, p.total, p.estado,
                      CAST(10 + p.id % 16 AS INT) AS tiempo_preparacion,
                      CAST(1 + p.id % 3 AS INT) AS prioridad, p.fecha_creacion
               FROM {pedidos} p JOIN {restaurantes} r ON r.id = p.restaurante_id""",
            pedidos=self.pedidos, restaurantes=self.restaurantes)

    @cached_property
    def posiciones(self) -> DataFrame:
        """Position reports of the couriers, one per event."""
        return self._sql(
            """SELECT user_id % (SELECT COUNT(*) FROM {supplier}) AS repartidor_id,
                      CAST(98400 + 10 * (event_id % 40) AS DOUBLE) / 10000 AS lat,
                      CAST(-839400 + 10 * (event_id % 37) AS DOUBLE) / 10000 AS lon,
                      ts, event_id AS secuencia
               FROM {events}""",
            events=self.tabla("events"), supplier=self.tabla("supplier"))
