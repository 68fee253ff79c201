"""Runs the headline queries once each and prints one JSON line with their times."""

from __future__ import annotations

import json
import os
import time

from comanda.plans.consultas import consultas
from comanda.plans.durable import trabajo
from comanda.session import crear_sesion

TITULARES = [
    "e05_hechos_reservas", "a01_ingresos_mes_categoria", "a02_actividad_geo", "a04_frecuencia_menu",
    "a05_usuarios_ingresos", "a06_tendencias_consumo", "a07_horarios_pico_detalle",
    "a09_crecimiento_mensual_detalle", "a11_ingresos_categoria_mes", "a12_tendencia_ingresos_categoria",
    "a13_top_productos_ingresos", "a14_actividad_zona_geografica", "a16_demografia_zona",
    "a18_pedidos_estado_temporal", "a19_pedidos_por_restaurante", "a20_cancelaciones_categoria",
    "a23_resumen_por_cocina", "q06_informe", "q07_reservas_completas", "j13_incluye_detalle",
    "g03_estadisticas_grafo", "g12_co_compras", "g13_co_compras_categoria", "g16_usuarios_influyentes",
    "g25_cadenas", "g29_comunidades", "g31_recomendar_productos", "r02_anclar_restaurantes",
    "r03_calle_mas_cercana", "r09_asignacion", "r10_rutas",
]


def main() -> None:
    carpeta = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = crear_sesion(f"local[{cpus}]", "comanda-bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    registro = consultas()
    # the first query of a session pays for starting it, which is not the query's cost
    registro["a24_conteo_hechos"](spark, carpeta).collect()
    tiempos = {}
    for nombre in TITULARES:
        t = time.perf_counter()
        with trabajo(spark):
            registro[nombre](spark, carpeta).write.format("noop").mode("overwrite").save()
            tiempos[nombre] = round(time.perf_counter() - t, 3)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(tiempos.values()), 3), "unit": "sec",
                      "queries": tiempos, "sf": os.path.basename(carpeta.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
