"""Dataset summaries, counters and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.functions.expr import cociente, dinero, doble


def conteo(df: DataFrame) -> Column:
    """Row count of a frame as a scalar subquery."""
    return df.agg(F.count("*")).scalar()


def una_fila(df: DataFrame, **columnas: Column) -> DataFrame:
    return df.sparkSession.range(1).select(*[c.alias(n) for n, c in columnas.items()])


def resumen(restaurantes: DataFrame, usuarios: DataFrame, productos: DataFrame, pedidos: DataFrame,
            detalle: DataFrame) -> DataFrame:
    """One row: entity counts, order totals over completed orders, and the period covered."""
    completado = F.col("estado") == "completado"
    valor = F.when(completado, F.col("total"))
    dia = F.to_date("fecha_creacion")
    return pedidos.agg(
        F.count("*").alias("pedidos"),
        F.count_if(completado).alias("pedidos_completados"),
        F.count_if(F.col("estado") == "cancelado").alias("pedidos_cancelados"),
        doble(dinero(valor)).alias("ingresos_total"),
        cociente(dinero(valor), F.count(valor)).alias("ticket_promedio"),
        F.min(dia).alias("fecha_inicio"), F.max(dia).alias("fecha_fin"),
        F.date_diff(F.max(dia), F.min(dia)).alias("dias_total"),
    ).select(conteo(restaurantes).alias("restaurantes"), conteo(usuarios).alias("usuarios"),
             conteo(productos).alias("productos"), "*", conteo(detalle).alias("detalles_pedido"))


def resumen_por_cocina(restaurantes: DataFrame, productos: DataFrame, pedidos: DataFrame) -> DataFrame:
    """Per cuisine: restaurants, products, completed orders and their revenue.  Products and
    orders are counted per restaurant first, so they are not multiplied by each other."""
    pr = productos.groupBy(F.col("restaurante_id").alias("id")).agg(F.count("*").alias("n_pr"))
    pe = (pedidos.filter("estado = 'completado'").groupBy(F.col("restaurante_id").alias("id"))
          .agg(F.count("*").alias("n_pe"), dinero("total").alias("s")))
    cero = F.lit(0)
    return (restaurantes.select("id", "categoria_local").join(pr, "id", "left").join(pe, "id", "left")
            .groupBy("categoria_local")
            .agg(F.count("*").alias("restaurantes"), F.sum(F.coalesce("n_pr", cero)).alias("productos"),
                 F.sum(F.coalesce("n_pe", cero)).alias("pedidos"),
                 doble(F.coalesce(F.sum("s"), cero)).alias("ingresos_total")))


def estadisticas_cesta(detalle: DataFrame, pedidos: DataFrame) -> DataFrame:
    """Basket statistics over detail edges (src = order, dst = product)."""
    por_pedido = detalle.groupBy("src").agg(F.count("*").alias("n"))
    return (por_pedido.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_detalle"),
                           F.count("*").alias("pedidos_con_detalle"))
            .select("*", conteo(pedidos).alias("total_pedidos"),
                    F.round(cociente(F.col("total_detalle"), F.col("pedidos_con_detalle")), 2)
                    .alias("promedio_productos_por_pedido")))


def estado_sistema(clientes: DataFrame, repartidores: DataFrame, pedidos: DataFrame, rutas: DataFrame) -> DataFrame:
    """Delivery state: registered customers, active couriers, order counts and active routes."""
    return pedidos.agg(F.count_if(F.col("estado") == "pendiente").alias("pedidos_pendientes"),
                       F.count_if(F.col("estado") == "en_ruta").alias("pedidos_en_ruta")).select(
        conteo(clientes).alias("clientes_registrados"),
        conteo(repartidores.filter("activo")).alias("repartidores_activos"), "*",
        rutas.agg(F.count_distinct("repartidor_id")).scalar().alias("rutas_activas"))


def estadisticas_carga(**tablas: DataFrame) -> DataFrame:
    """Rows per loaded entity."""
    partes = [df.agg(F.count("*").alias("cantidad")).select(F.lit(n).alias("entidad"), "cantidad")
              for n, df in tablas.items()]
    total = partes[0]
    for p in partes[1:]:
        total = total.unionByName(p)
    return total


def mejores_clientes(usuarios: DataFrame, pedidos: DataFrame, k: int = 10) -> DataFrame:
    por_usuario = pedidos.groupBy("usuario_id").agg(F.count("*").alias("total_pedidos"),
                                                    doble(dinero("total")).alias("gasto_total"))
    return (por_usuario.join(usuarios.select(F.col("id").alias("usuario_id"), "email"), "usuario_id")
            .orderBy(F.desc("total_pedidos"), F.desc("gasto_total"), "email").limit(k)
            .select("email", "total_pedidos", "gasto_total"))
