"""The warehouse build: landing tables to star tables, analyses and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from comanda.operators import cubes, star
from comanda.sources.sinks import BASE, crear_base, crear_vistas, reemplazar_tabla


def construir_estrella(usuarios: DataFrame, restaurantes: DataFrame, menus: DataFrame, reservas: DataFrame,
                       pedidos: DataFrame, base: str = BASE) -> None:
    """Writes the four dimensions and the fact.  The time key is a function of the timestamp, so
    the dimension and the fact agree although they are computed separately."""
    crear_base(usuarios.sparkSession, base)
    reemplazar_tabla(star.dim_usuario(usuarios), "dim_usuario", base)
    reemplazar_tabla(star.dim_restaurante(restaurantes), "dim_restaurante", base)
    reemplazar_tabla(star.dim_menu(menus), "dim_menu", base)
    reemplazar_tabla(star.dim_tiempo(reservas), "dim_tiempo", base)
    reemplazar_tabla(star.hechos_reservas(reservas, pedidos), "hechos_reservas", base)


def analisis(spark: SparkSession, base: str = BASE) -> list[str]:
    """Writes the derived tables, each computed once; nothing is written for an empty fact."""
    hechos, menu = spark.table(f"{base}.hechos_reservas"), spark.table(f"{base}.dim_menu")
    if hechos.isEmpty():
        return []
    tablas = {
        "dw_tendencias_consumo": cubes.tendencias_consumo(hechos, menu),
        "dw_horarios_pico_detalle": cubes.horarios_pico_detalle(hechos),
        "dw_horarios_pico": cubes.horarios_pico(hechos),
        "dw_crecimiento_mensual_detalle": cubes.crecimiento_mensual_detalle(hechos),
        "dw_crecimiento_mensual": cubes.crecimiento_mensual(hechos),
    }
    for nombre, df in tablas.items():
        reemplazar_tabla(df, nombre, base)
    return list(tablas)


def vistas_de_cubos(spark: SparkSession, base: str = BASE) -> None:
    t = lambda n: spark.table(f"{base}.{n}")
    crear_vistas({
        "cubo_ingresos_mes_categoria": lambda: cubes.ingresos_mes_categoria(t("hechos_reservas"), t("dim_menu")),
        "cubo_actividad_geo": lambda: cubes.actividad_geo(t("hechos_reservas"), t("dim_restaurante")),
        "cubo_estado_pedido_mes": lambda: cubes.estado_pedido_mes(t("hechos_reservas")),
        "cubo_frecuencia_menu": lambda: cubes.frecuencia_menu(t("hechos_reservas"), t("dim_menu")),
        "cubo_usuarios_ingresos": lambda: cubes.usuarios_ingresos(t("hechos_reservas"), t("dim_usuario")),
    })


def vistas_de_tablero(pedidos: DataFrame, reservas: DataFrame, usuarios: DataFrame, menus: DataFrame,
                      restaurantes: DataFrame) -> None:
    from comanda.operators import dashboards as tab

    fp, fr = tab.fact_pedidos(pedidos), tab.fact_reservas(reservas)
    u, m, r = tab.dim_usuario(usuarios), tab.dim_menu(menus), tab.dim_restaurante(restaurantes)
    crear_vistas({
        "v_ingresos_categoria_mes": lambda: tab.ingresos_categoria_mes(fp, m),
        "v_tendencia_ingresos_categoria": lambda: tab.tendencia_ingresos_categoria(fp, m),
        "v_top_productos_ingresos": lambda: tab.top_productos_ingresos(fp, m, r),
        "v_actividad_zona_geografica": lambda: tab.actividad_zona_geografica(u, fp, fr),
        "v_actividad_zona_temporal": lambda: tab.actividad_zona_temporal(u, fp),
        "v_demografia_zona": lambda: tab.demografia_zona(u, fp),
        "v_estadisticas_pedidos": lambda: tab.estadisticas_pedidos(fp),
        "v_pedidos_estado_temporal": lambda: tab.pedidos_estado_temporal(fp),
        "v_pedidos_por_restaurante": lambda: tab.pedidos_por_restaurante(fp, r),
        "v_cancelaciones_categoria": lambda: tab.cancelaciones_categoria(fp, m),
        "v_rendimiento_horario": lambda: tab.rendimiento_horario(fp),
    })
