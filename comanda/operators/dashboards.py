"""Dashboard views over the order schema (fact_pedidos, fact_reservas and its dimensions)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.expr import (clave_tiempo, cociente, crecimiento, dinero, doble, grupo_edad,
                                    instante, porcentaje)

_PARTES = {
    "anio": F.year,
    "mes": F.month,
    "nombre_mes": lambda t: F.date_format(t, "MMMM"),
    "dia_semana": F.dayofweek,
    "nombre_dia_semana": lambda t: F.date_format(t, "EEEE"),
    "hora": F.hour,
}


# ---- schema: a projection of the landing tables --------------------------------------------

def fact_pedidos(pedidos: DataFrame) -> DataFrame:
    return pedidos.select(
        F.col("id").alias("id_pedido"), clave_tiempo(F.col("fecha_creacion")).alias("id_tiempo"),
        F.col("menu_id").alias("id_menu"), F.col("restaurante_id").alias("id_restaurante"),
        F.col("usuario_id").alias("id_usuario"), F.col("total").alias("precio_total"), "cantidad", "estado")


def fact_pedidos_cabecera(cabecera: DataFrame) -> DataFrame:
    """Orders without the columns taken from their lines, for views that need none of them."""
    return cabecera.select(
        F.col("id").alias("id_pedido"), clave_tiempo(F.col("fecha_creacion")).alias("id_tiempo"),
        F.col("usuario_id").alias("id_usuario"), F.col("total").alias("precio_total"), "estado")


def fact_reservas(reservas: DataFrame) -> DataFrame:
    return reservas.select(F.col("id").alias("id_reserva"), F.col("usuario_id").alias("id_usuario"),
                           F.col("invitados").alias("numero_personas"))


def dim_usuario(usuarios: DataFrame) -> DataFrame:
    return usuarios.select(F.col("id").alias("id_usuario"), "ciudad", "pais", "edad")


def dim_menu(menus: DataFrame) -> DataFrame:
    return menus.select(F.col("id").alias("id_menu"), "titulo", "categoria")


def dim_restaurante(restaurantes: DataFrame) -> DataFrame:
    return restaurantes.select(F.col("id").alias("id_restaurante"), "nombre", "ciudad")


def dim_tiempo(pedidos: DataFrame) -> DataFrame:
    ts = F.col("fecha_creacion")
    return (pedidos.select(ts).filter(ts.isNotNull()).distinct()
            .select(clave_tiempo(ts).alias("id_tiempo"), *[f(ts).alias(n) for n, f in _PARTES.items()]))


def _con_tiempo(fp: DataFrame, columnas: list[str], tiempo: DataFrame | None) -> DataFrame:
    if tiempo is not None:
        return fp.join(tiempo.select("id_tiempo", *columnas), "id_tiempo")
    ts = instante(F.col("id_tiempo"))
    return fp.filter(F.col("id_tiempo").isNotNull()).select("*", *[_PARTES[c](ts).alias(c) for c in columnas])


_COMPLETADO = "estado = 'completado'"
_CANCELADO = "estado = 'cancelado'"


# ---- revenue by month and category ---------------------------------------------------------

def ingresos_categoria_mes(fp: DataFrame, menu: DataFrame, tiempo: DataFrame | None = None) -> DataFrame:
    t = ["anio", "mes", "nombre_mes"]
    parcial = (_con_tiempo(fp.filter(_COMPLETADO), t, tiempo).groupBy(*t, "id_menu")
               .agg(F.count("id_pedido").alias("n"), dinero("precio_total").alias("s"),
                    F.count("precio_total").alias("np"), F.sum("cantidad").alias("q")))
    return (parcial.join(menu.select("id_menu", "categoria"), "id_menu").groupBy(*t, "categoria")
            .agg(F.sum("n").alias("total_pedidos"), doble(F.sum("s")).alias("ingresos_total"),
                 cociente(F.sum("s"), F.sum("np")).alias("ingreso_promedio"),
                 F.sum("q").alias("cantidad_total"))
            .orderBy(F.desc("anio"), F.desc("mes"), F.desc("ingresos_total"), "categoria"))


def tendencia_ingresos_categoria(fp: DataFrame, menu: DataFrame, tiempo: DataFrame | None = None) -> DataFrame:
    t = ["anio", "mes"]
    parcial = (_con_tiempo(fp.filter(_COMPLETADO), t, tiempo).groupBy(*t, "id_menu")
               .agg(dinero("precio_total").alias("s")))
    por_categoria = W.partitionBy("categoria").orderBy("anio", "mes")
    return (parcial.join(menu.select("id_menu", "categoria"), "id_menu").groupBy("categoria", *t)
            .agg(doble(F.sum("s")).alias("ingresos_mes"))
            .withColumn("ingresos_mes_anterior", F.lag("ingresos_mes").over(por_categoria))
            .withColumn("crecimiento_porcentual",
                        crecimiento(F.col("ingresos_mes"), F.col("ingresos_mes_anterior")))
            .orderBy("categoria", F.desc("anio"), F.desc("mes")))


def top_productos_ingresos(fp: DataFrame, menu: DataFrame, restaurante: DataFrame, k: int = 20) -> DataFrame:
    """The rank is computed over the k kept rows only: every row that outranks one of them is
    itself kept, so the global sort is a distributed top-k instead of a one-task window."""
    parcial = (fp.filter(_COMPLETADO).groupBy("id_menu", "id_restaurante")
               .agg(F.count("id_pedido").alias("n"), dinero("precio_total").alias("s"),
                    F.count("precio_total").alias("np")))
    m = menu.select("id_menu", F.col("titulo").alias("producto"), "categoria")
    r = restaurante.select("id_restaurante", F.col("nombre").alias("restaurante"))
    mejores = (parcial.join(m, "id_menu").join(r, "id_restaurante")
               .groupBy("producto", "categoria", "restaurante")
               .agg(F.sum("n").alias("total_pedidos"), doble(F.sum("s")).alias("ingresos_total"),
                    cociente(F.sum("s"), F.sum("np")).alias("precio_promedio"))
               .orderBy(F.desc("ingresos_total"), "producto", "categoria", "restaurante").limit(k))
    return (mejores.withColumn("ranking", F.rank().over(W.orderBy(F.desc("ingresos_total"))))
            .orderBy(F.desc("ingresos_total"), "producto", "categoria", "restaurante"))


# ---- customer activity by zone -------------------------------------------------------------

def _por_usuario(fp: DataFrame, fr: DataFrame) -> tuple[DataFrame, DataFrame]:
    p = fp.groupBy("id_usuario").agg(F.count("id_pedido").alias("n_p"), F.count("*").alias("filas_p"),
                                     dinero("precio_total").alias("s_p"),
                                     F.count("precio_total").alias("c_p"))
    r = fr.groupBy("id_usuario").agg(F.count("id_reserva").alias("n_r"), F.count("*").alias("filas_r"),
                                     F.sum("numero_personas").alias("s_r"),
                                     F.count("numero_personas").alias("c_r"))
    return p, r


def actividad_zona_geografica(usuario: DataFrame, fp: DataFrame, fr: DataFrame,
                              corregida: bool = False) -> DataFrame:
    """Users left-joined to orders and to reservations at once, so each order counts once per
    reservation of its user and the reverse.  Those products are computed from per-user sums
    and never materialised.  ``corregida`` counts every order and reservation once."""
    p, r = _por_usuario(fp, fr)
    u = usuario.filter("ciudad IS NOT NULL AND pais IS NOT NULL").select("id_usuario", "ciudad", "pais")
    base = u.join(p, "id_usuario", "left").join(r, "id_usuario", "left")
    uno = F.lit(1).cast("bigint")
    veces_p = uno if corregida else F.greatest(F.coalesce("filas_r", uno), uno)
    veces_r = uno if corregida else F.greatest(F.coalesce("filas_p", uno), uno)
    suma = F.sum(F.col("s_p") * veces_p)
    return (base.groupBy("ciudad", "pais")
            .agg(F.count_distinct("id_usuario").alias("total_clientes"),
                 F.coalesce(F.sum(F.col("n_p") * veces_p), F.lit(0)).alias("total_pedidos"),
                 doble(suma).alias("ingresos_zona"),
                 cociente(suma, F.sum(F.col("c_p") * veces_p)).alias("ticket_promedio"),
                 F.coalesce(F.sum(F.col("n_r") * veces_r), F.lit(0)).alias("total_reservas"),
                 F.round(cociente(F.sum(F.col("s_r") * veces_r), F.sum(F.col("c_r") * veces_r)), 2)
                 .alias("personas_promedio_reserva"))
            .filter("total_pedidos > 0").orderBy(F.desc("ingresos_zona"), "ciudad"))


def actividad_zona_temporal(usuario: DataFrame, fp: DataFrame, tiempo: DataFrame | None = None) -> DataFrame:
    t = ["anio", "mes", "nombre_mes"]
    parcial = (_con_tiempo(fp.filter(_COMPLETADO), t, tiempo).groupBy(*t, "id_usuario")
               .agg(F.count("id_pedido").alias("n"), dinero("precio_total").alias("s")))
    return (parcial.join(usuario.select("id_usuario", "ciudad", "pais"), "id_usuario")
            .groupBy("ciudad", "pais", *t)
            .agg(F.sum("n").alias("pedidos_mes"), doble(F.sum("s")).alias("ingresos_mes"),
                 F.count_distinct("id_usuario").alias("clientes_activos"))
            .orderBy("ciudad", F.desc("anio"), F.desc("mes"), "pais"))


def demografia_zona(usuario: DataFrame, fp: DataFrame) -> DataFrame:
    p = fp.groupBy("id_usuario").agg(dinero("precio_total").alias("s"), F.count("precio_total").alias("n"))
    u = (usuario.filter("ciudad IS NOT NULL AND edad IS NOT NULL")
         .select("id_usuario", "ciudad", "pais", grupo_edad(F.col("edad")).alias("grupo_edad")))
    return (u.join(p, "id_usuario", "left").groupBy("ciudad", "pais", "grupo_edad")
            .agg(F.count_distinct("id_usuario").alias("total_clientes"),
                 cociente(F.sum("s"), F.sum("n")).alias("ticket_promedio_grupo"))
            .orderBy("ciudad", "pais", "grupo_edad"))


# ---- completed against cancelled orders ----------------------------------------------------

def estadisticas_pedidos(fp: DataFrame) -> DataFrame:
    n = F.col("total_pedidos")
    return (fp.groupBy("estado")
            .agg(F.count("id_pedido").alias("total_pedidos"), doble(dinero("precio_total")).alias("valor_total"),
                 cociente(dinero("precio_total"), F.count("precio_total")).alias("valor_promedio"))
            .withColumn("porcentaje_total", porcentaje(n, F.sum(n).over(W.partitionBy())))
            .orderBy(F.desc("total_pedidos"), "estado"))


def pedidos_estado_temporal(fp: DataFrame, tiempo: DataFrame | None = None) -> DataFrame:
    t = ["anio", "mes", "nombre_mes", "dia_semana", "nombre_dia_semana"]
    n = F.col("total_pedidos")
    return (_con_tiempo(fp, t, tiempo).groupBy(*t, "estado")
            .agg(F.count("id_pedido").alias("total_pedidos"), doble(dinero("precio_total")).alias("valor_total"))
            .withColumn("porcentaje_mes", porcentaje(n, F.sum(n).over(W.partitionBy("anio", "mes"))))
            .orderBy(F.desc("anio"), F.desc("mes"), "dia_semana", "estado"))


def pedidos_por_restaurante(fp: DataFrame, restaurante: DataFrame) -> DataFrame:
    """One row per restaurant id and status; the share is within the restaurant."""
    n = F.col("total_pedidos")
    parcial = (fp.groupBy("id_restaurante", "estado")
               .agg(F.count("id_pedido").alias("total_pedidos"), doble(dinero("precio_total")).alias("valor_total"),
                    cociente(dinero("precio_total"), F.count("precio_total")).alias("ticket_promedio"))
               .withColumn("porcentaje_restaurante",
                           porcentaje(n, F.sum(n).over(W.partitionBy("id_restaurante")))))
    return (parcial.join(restaurante, "id_restaurante")
            .select(F.col("nombre").alias("restaurante"), F.col("ciudad").alias("ciudad_restaurante"), "estado",
                    "total_pedidos", "valor_total", "porcentaje_restaurante", "ticket_promedio")
            .orderBy("restaurante", F.desc("total_pedidos"), "estado"))


def _por_estado(n_nombre: str):
    cero = F.lit(0).cast("decimal(18,2)")
    valor = F.col("precio_total").cast("decimal(18,2)")
    return [F.count_if(F.expr(_COMPLETADO)).alias("pedidos_completados"),
            F.count_if(F.expr(_CANCELADO)).alias("pedidos_cancelados"),
            F.count("id_pedido").alias(n_nombre),
            F.sum(F.when(F.expr(_COMPLETADO), valor).otherwise(cero)).alias("s_completado"),
            F.sum(F.when(F.expr(_CANCELADO), valor).otherwise(cero)).alias("s_cancelado")]


def cancelaciones_categoria(fp: DataFrame, menu: DataFrame) -> DataFrame:
    parcial = fp.groupBy("id_menu").agg(*_por_estado("total_pedidos"))
    sumas = ["pedidos_completados", "pedidos_cancelados", "total_pedidos", "s_completado", "s_cancelado"]
    return (parcial.join(menu.select("id_menu", "categoria"), "id_menu").groupBy("categoria")
            .agg(*[F.sum(c).alias(c) for c in sumas])
            .select("categoria", "pedidos_completados", "pedidos_cancelados", "total_pedidos",
                    porcentaje(F.col("pedidos_cancelados"), F.col("total_pedidos")).alias("tasa_cancelacion"),
                    doble("s_completado").alias("ingresos_completados"),
                    doble("s_cancelado").alias("ingresos_perdidos"))
            .orderBy(F.desc("tasa_cancelacion"), "categoria"))


def rendimiento_horario(fp: DataFrame, tiempo: DataFrame | None = None) -> DataFrame:
    return (_con_tiempo(fp, ["hora"], tiempo).groupBy("hora").agg(*_por_estado("total_pedidos"))
            .select("hora", "total_pedidos", "pedidos_completados", "pedidos_cancelados",
                    porcentaje(F.col("pedidos_completados"), F.col("total_pedidos")).alias("tasa_completado"),
                    doble("s_completado").alias("ingresos_hora"))
            .orderBy("hora"))
