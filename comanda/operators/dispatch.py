"""Order assignment to couriers and their delivery tours."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.geo import RADIO_TIERRA_M, VELOCIDAD_KMH, minutos_viaje
from comanda.operators.paths import Trayectos, caminos_de_trayectos, entre_pares
from comanda.operators.spatial import calle_mas_cercana
from comanda.plans.durable import Corte

MINUTOS_POR_ENTREGA = 5
MAX_SALTOS = 20
PARTES_ZONA = 64

_ASIGNACION = "zona string, pedido_id bigint, repartidor_id bigint, turno int, costo int"


def _minutos(lat1, lon1, lat2, lon2, kmh):
    a = (np.sin(np.radians(lat2 - lat1) / 2) ** 2
         + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * np.sin(np.radians(lon2 - lon1) / 2) ** 2)
    metros = 2 * RADIO_TIERRA_M * np.arctan2(np.sqrt(a), np.sqrt(1 - a))
    return np.where(metros <= 0, 0, np.maximum(1, np.floor(metros / 1000 / kmh * 60)))


def _turnos(pedidos: pd.DataFrame, repartidores: pd.DataFrame) -> pd.DataFrame:
    """Orders in turn; each goes to the cheapest courier with room, ties to the smallest id."""
    filas = []
    if len(pedidos) and len(repartidores):
        p = pedidos.sort_values("turno", kind="stable")
        r = repartidores.sort_values("id", kind="stable")
        lat, lon, kmh = (r[c].to_numpy(float) for c in ("lat", "lon", "velocidad_promedio"))
        carga, tope, ids = r["carga"].to_numpy(np.int64).copy(), r["capacidad_max"].to_numpy(), r["id"].to_numpy()
        for o in p.itertuples(index=False):
            costo = np.where(carga < tope, _minutos(lat, lon, o.lat, o.lon, kmh) + 10 * carga, np.inf)
            i = int(np.argmin(costo))
            if not np.isfinite(costo[i]):
                break
            carga[i] += 1
            filas.append((o.zona, o.pedido_id, int(ids[i]), o.turno, int(costo[i])))
    return pd.DataFrame(filas, columns=["zona", "pedido_id", "repartidor_id", "turno", "costo"])


def asignar(pedidos: DataFrame, repartidores: DataFrame, clientes: DataFrame) -> DataFrame:
    """Greedy assignment per dispatch zone: (zona, pedido_id, repartidor_id, turno, costo).

    Within a zone the result is that of taking the pending orders by priority, creation time
    and id, one after the other.  Each taken order fills one free slot, so only as many orders
    as the zone has free slots can be assigned; the others are dropped before anything is
    grouped, and a group holds the zone's couriers and that many orders.
    """
    libres = repartidores.filter("activo AND carga < capacidad_max")
    plazas = libres.groupBy("zona").agg(F.sum(F.col("capacidad_max") - F.col("carga")).alias("plazas"))
    tope = plazas.agg(F.max("plazas")).first()[0] or 0
    turno = [F.desc("prioridad"), F.asc("fecha_creacion"), F.asc("pedido_id")]
    por_parte, por_zona = W.partitionBy("zona", "_parte").orderBy(*turno), W.partitionBy("zona").orderBy(*turno)
    c = clientes.select(F.col("id").alias("cliente_id"), "lat", "lon")
    cola = (pedidos.filter("estado = 'pendiente'")
            .select("zona", F.col("id").alias("pedido_id"), "cliente_id", "prioridad", "fecha_creacion")
            .join(c, "cliente_id")
            # first orders of each part of a zone, so that a zone with most orders is cut in parallel
            .withColumn("_parte", F.pmod(F.xxhash64("pedido_id"), F.lit(PARTES_ZONA)))
            .withColumn("_puesto", F.row_number().over(por_parte)).filter(F.col("_puesto") <= tope)
            .withColumn("turno", F.row_number().over(por_zona))
            .join(plazas, "zona").filter(F.col("turno") <= F.col("plazas"))
            .select("zona", "pedido_id", "turno", "lat", "lon"))
    r = libres.select("zona", "id", "lat", "lon", "velocidad_promedio", "carga", "capacidad_max")
    return cola.groupBy("zona").cogroup(r.groupBy("zona")).applyInPandas(_turnos, _ASIGNACION)


def aplicar_asignacion(pedidos: DataFrame, asignacion: DataFrame) -> DataFrame:
    """Orders with status ``asignado`` and their courier where one was found."""
    a = asignacion.select(F.col("pedido_id").alias("id"), "repartidor_id")
    return (pedidos.join(a, "id", "left")
            .withColumn("estado", F.when(F.col("repartidor_id").isNotNull(), "asignado").otherwise(F.col("estado")))
            .withColumnRenamed("repartidor_id", "repartidor_asignado"))


# The nearest unvisited stop, repeatedly, over one courier's stops (at most its capacity).
# ``d`` maps (from node, to node) to metres; stops without a path never become candidates.
_RECORRIDO = """
aggregate(paradas,
  named_struct('en', calle, 'quedan', paradas, 'tramos', array_compact(array(
    CAST(NULL AS STRUCT<distancia: DOUBLE, turno: INT, pedido_id: BIGINT, nodo: BIGINT, desde: BIGINT>)))),
  (s, _x) -> transform(array(array_min(filter(transform(s.quedan, q -> named_struct(
      'distancia', try_element_at(d, named_struct('a', s.en, 'b', q.nodo)), 'turno', q.turno,
      'pedido_id', q.pedido_id, 'nodo', q.nodo, 'desde', s.en)), c -> c.distancia IS NOT NULL))),
    m -> if(m IS NULL, s, named_struct('en', m.nodo, 'quedan', filter(s.quedan, q -> q.turno <> m.turno),
      'tramos', array_append(s.tramos, m))))[0],
  s -> s.tramos)
"""


def tramos(asignados: DataFrame, repartidores: DataFrame, destinos: DataFrame, nodos: DataFrame,
           aristas: DataFrame, max_saltos: int = MAX_SALTOS) -> tuple[DataFrame, Trayectos]:
    """Nearest-neighbour tours without what they leave out: the first two of ``tramos_y_resto``."""
    return tramos_y_resto(asignados, repartidores, destinos, nodos, aristas, max_saltos)[:2]


def tramos_y_resto(asignados: DataFrame, repartidores: DataFrame, destinos: DataFrame, nodos: DataFrame,
                   aristas: DataFrame, max_saltos: int = MAX_SALTOS) -> tuple[DataFrame, Trayectos, DataFrame]:
    """Nearest-neighbour tours: one row per leg (repartidor_id, orden, pedido_id, desde, nodo,
    distancia), the paths they were measured with, and the assigned orders without a leg
    (repartidor_id, pedido_id, motivo).  Every assigned order is in one of the two.

    ``asignados(pedido_id, repartidor_id, turno)``, ``destinos(pedido_id, lat, lon)``,
    ``repartidores(id, lat, lon)``.  A leg follows the path of fewest segments.
    """
    corte = Corte(asignados.sparkSession, "tramos")
    a, _ = corte.guardar(asignados.select("pedido_id", "repartidor_id", "turno"))
    r = repartidores.select("id", "lat", "lon").join(
        a.select(F.col("repartidor_id").alias("id")), "id", "left_semi")
    inicio = calle_mas_cercana(r, nodos).filter("calle_id IS NOT NULL").select(
        F.col("id").alias("repartidor_id"), F.col("calle_id").alias("calle"))
    # read for their places and for their answers
    destinos, _ = corte.guardar(destinos.join(a, "pedido_id"), contar=False)
    lugar = calle_mas_cercana(destinos, nodos).filter("calle_id IS NOT NULL")
    lugar, _ = corte.guardar(lugar.select("repartidor_id", "turno", "pedido_id", F.col("calle_id").alias("nodo")))
    inicio, _ = corte.guardar(inicio)
    p = lugar.join(inicio, "repartidor_id").select("repartidor_id", "turno", "pedido_id", "nodo")
    # node pairs a courier may travel: its start and its stops, to its stops
    salidas = inicio.select("repartidor_id", F.col("calle").alias("a")).unionByName(
        p.select("repartidor_id", F.col("nodo").alias("a"))).distinct()
    pares = salidas.join(p.select("repartidor_id", F.col("nodo").alias("b")).distinct(), "repartidor_id")
    t = entre_pares(pares.select(F.col("a").alias("origen"), F.col("b").alias("destino")), aristas, max_saltos, nodos)
    d = t.pares.select(F.col("origen").alias("a"), F.col("destino").alias("b"), "distancia")
    mapa = (pares.join(d, ["a", "b"]).groupBy("repartidor_id")
            .agg(F.map_from_entries(F.collect_list(F.struct(F.struct("a", "b"), "distancia"))).alias("d")))
    paradas = p.groupBy("repartidor_id").agg(
        F.sort_array(F.collect_list(F.struct("turno", "pedido_id", "nodo"))).alias("paradas"))
    legs = (paradas.join(inicio, "repartidor_id").join(mapa, "repartidor_id")
            .select("repartidor_id", F.posexplode(F.expr(_RECORRIDO)).alias("orden", "t"))
            .select("repartidor_id", (F.col("orden") + 1).alias("orden"), "t.pedido_id", "t.desde", "t.nodo",
                    "t.distancia"))
    legs, _ = corte.guardar(legs)
    clave = ["repartidor_id", "pedido_id"]
    hay = lambda df, *c: df.select(*c).distinct().withColumn("_" + c[-1], F.lit(True))
    resto = (a.select(*clave).join(legs.select(*clave), clave, "left_anti")
             .join(hay(inicio, "repartidor_id"), "repartidor_id", "left")
             .join(hay(lugar, "pedido_id"), "pedido_id", "left")
             .select(*clave, F.when(F.col("_repartidor_id").isNull(), "repartidor sin nodo")
                     .when(F.col("_pedido_id").isNull(), "destino sin nodo")
                     .otherwise(f"sin camino de {max_saltos} segmentos o menos").alias("motivo")))
    resto, _ = corte.guardar(resto)
    return legs, t, resto


def tramos_completos(legs: DataFrame, resto: DataFrame) -> DataFrame:
    """One row per assigned order: its leg, or ``motivo`` and nulls where it has none."""
    return legs.withColumn("motivo", F.lit(None).cast("string")).unionByName(resto, allowMissingColumns=True)


def con_resto(por_repartidor: DataFrame, resto: DataFrame) -> DataFrame:
    """Rows per courier with ``pedidos_sin_ruta``, the (pedido_id, motivo) of its assigned orders without a leg;
    couriers that have no others get a row."""
    r = resto.groupBy("repartidor_id").agg(
        F.sort_array(F.collect_list(F.struct("pedido_id", "motivo"))).alias("pedidos_sin_ruta"))
    vacio = F.array().cast(r.schema["pedidos_sin_ruta"].dataType)
    return (por_repartidor.join(r, "repartidor_id", "full")
            .withColumn("pedidos_sin_ruta", F.coalesce("pedidos_sin_ruta", vacio)))


def rutas(legs: DataFrame, kmh: float = VELOCIDAD_KMH) -> DataFrame:
    """One row per courier: ordered stops, total metres and total minutes with service time."""
    minutos = minutos_viaje(F.col("distancia"), kmh) + MINUTOS_POR_ENTREGA
    return (legs.groupBy("repartidor_id")
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("orden", "pedido_id"))),
                             lambda x: x["pedido_id"]).alias("pedidos"),
                 F.sum("distancia").alias("distancia_total"), F.sum(minutos).cast("int").alias("tiempo_total")))


def trazado(legs: DataFrame, t: Trayectos) -> DataFrame:
    """Node ids of each whole tour: the start, then the path of every leg."""
    pares = legs.select(F.col("desde").alias("origen"), F.col("nodo").alias("destino"), "repartidor_id", "orden")
    c = caminos_de_trayectos(pares, t)
    inicio = F.col("l")[0]["calles"][0]
    return (c.groupBy("repartidor_id").agg(F.sort_array(F.collect_list(F.struct("orden", "calles"))).alias("l"))
            .select("repartidor_id", F.concat(F.array(inicio), F.flatten(F.transform("l", lambda x: x["calles"])))
                    .alias("calles_ruta")))


def tiempos_estimados(ruta: DataFrame) -> DataFrame:
    """Estimated minutes per order: equal whole shares of the tour, accumulated in stop order."""
    parte = F.floor(F.col("tiempo_total") / F.size("pedidos")).cast("int")
    return (ruta.withColumn("_parte", parte).select("repartidor_id", "_parte", F.posexplode("pedidos").alias("_i", "pedido_id"))
            .select("repartidor_id", "pedido_id", (F.col("_i") + 1).alias("parada"),
                    (F.col("_parte") * (F.col("_i") + 1)).alias("tiempo_estimado_entrega")))


def progreso(ruta: DataFrame, pedidos: DataFrame) -> DataFrame:
    """Delivered and remaining stops of each active route, from the status of its orders."""
    paradas = ruta.select("repartidor_id", "tiempo_total", "distancia_total", F.explode("pedidos").alias("id"))
    entregado = F.count_if(F.col("estado") == "entregado")
    return (paradas.join(pedidos.select("id", "estado"), "id")
            .groupBy("repartidor_id", "distancia_total", "tiempo_total")
            .agg(entregado.alias("pedidos_entregados"), (F.count("*") - entregado).alias("pedidos_restantes"))
            .select("repartidor_id", "distancia_total", "pedidos_entregados", "pedidos_restantes",
                    F.when(F.col("pedidos_restantes") > 0, F.col("tiempo_total")).otherwise(0)
                    .alias("tiempo_estimado_restante")))


def progreso_completo(ruta: DataFrame, resto: DataFrame, pedidos: DataFrame) -> DataFrame:
    """``progreso`` of every courier with assigned orders; those without a leg are counted by status as well:
    delivered with the others, open in ``pedidos_sin_ruta``, since no tour goes there."""
    p = progreso(ruta, pedidos)
    entregado = F.coalesce(F.col("estado") == "entregado", F.lit(False))
    r = (resto.join(pedidos.select(F.col("id").alias("pedido_id"), "estado"), "pedido_id", "left")
         .groupBy("repartidor_id").agg(F.count_if(entregado).alias("_e"), F.count_if(~entregado).alias("_s")))
    cero = lambda c: F.coalesce(c, F.lit(0))
    return p.join(r, "repartidor_id", "full").select(
        "repartidor_id", "distancia_total", (cero("pedidos_entregados") + cero("_e")).alias("pedidos_entregados"),
        cero("pedidos_restantes").alias("pedidos_restantes"), "tiempo_estimado_restante",
        cero("_s").alias("pedidos_sin_ruta"))


def completar_entregas(pedidos: DataFrame, completados: DataFrame) -> DataFrame:
    """Sets status ``entregado`` on the orders named in ``completados(pedido_id)``."""
    c = completados.select(F.col("pedido_id").alias("id")).distinct().withColumn("_hecho", F.lit(True))
    return (pedidos.join(c, "id", "left")
            .withColumn("estado", F.when(F.col("_hecho"), "entregado").otherwise(F.col("estado"))).drop("_hecho"))


def rutas_activas(legs: DataFrame, pedidos: DataFrame) -> DataFrame:
    """Couriers (repartidor_id) whose tour has an order that is not delivered yet, one row each.  Orders without a row
    or a status in ``pedidos(id, estado)`` count as open, as in ``progreso_completo``."""
    hechos = pedidos.filter("estado = 'entregado'").select(F.col("id").alias("pedido_id"))
    return legs.join(hechos, "pedido_id", "left_anti").select("repartidor_id").distinct()


def carga_actual(repartidores: DataFrame, pedidos: DataFrame) -> DataFrame:
    """Couriers with the number of open orders they carry (delivered ones free their slot)."""
    abiertos = (pedidos.filter("repartidor_asignado IS NOT NULL AND estado <> 'entregado'")
                .groupBy(F.col("repartidor_asignado").alias("id")).agg(F.count("*").cast("int").alias("_c")))
    return (repartidores.drop("carga").join(abiertos, "id", "left")
            .withColumn("carga", F.coalesce("_c", F.lit(0))).drop("_c"))
