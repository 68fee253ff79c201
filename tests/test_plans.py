"""What the physical plans must and must not contain."""

import re

import pytest

from comanda.operators import star
from comanda.plans.almacen import cubes
from comanda.plans.consultas import consultas
from comanda.sources.derivadas import Dominio

PEREZOSAS = [n for n in consultas() if n[0] in "aejqx"] + ["g01_nodos_por_tipo", "g02_relaciones_por_tipo", "g13_co_compras_categoria",
                                                          "g20_mas_recomiendan", "g31_recomendar_productos"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("nombre", PEREZOSAS)
def test_sin_productos_cartesianos(spark, carpeta, nombre):
    p = _plan(consultas()[nombre](spark, carpeta))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p


def test_columnas_y_filtros_llegan_a_la_lectura(spark, carpeta, tmp_path):
    d = Dominio(spark, carpeta)
    star.hechos_reservas(d.reservas, d.pedidos_cabecera).write.parquet(f"{tmp_path}/h")
    h = spark.read.parquet(f"{tmp_path}/h")
    p = cubes.horarios_pico_detalle(h)._jdf.queryExecution().toString()
    assert "EqualTo(estado_reserva,ACTIVE)" in p
    assert "ReadSchema: struct<tiempo_id:bigint,total:double,estado_reserva:string,invitados:int>" in p


def test_agrega_antes_de_unir(spark, carpeta):
    """The fact is reduced to one row per key before the dimension is joined."""
    d = Dominio(spark, carpeta)
    h = star.hechos_reservas(d.reservas, d.pedidos_cabecera)
    p = _plan(cubes.frecuencia_menu(h, star.dim_menu(d.menus)))
    assert re.search("(HashJoin|SortMergeJoin)", p).start() < p.index("keys=[menu_id")
