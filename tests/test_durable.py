"""What operators write for themselves goes with the block that they ran in."""

import os

import pytest
from pyspark.sql import functions as F

from comanda.operators import paths
from comanda.plans import durable, vueltas
from comanda.sources.derivadas import Dominio


def _quedan(spark):
    carpeta = durable.carpeta_compartida(spark).removeprefix("file:")
    tablas = spark.sql(f"SHOW TABLES IN {durable._BASE}").count() if spark.catalog.databaseExists(durable._BASE) else 0
    bases = spark.sql("SHOW DATABASES LIKE 'comanda_vuelta_*'").count()
    return sorted(os.listdir(carpeta)) if os.path.isdir(carpeta) else [], tablas, bases


def test_nada_queda(spark, carpeta):
    antes = _quedan(spark)
    e = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0)], "src long, dst long, distancia double")
    o = spark.createDataFrame([(1,)], "origen long")
    with durable.trabajo(spark):
        assert paths.etiquetas(o, e).count() == 3
        assert vueltas.hechos_guardados(Dominio(spark, carpeta)).count() > 0
        assert _quedan(spark) != antes
    assert _quedan(spark) == antes
    roto = e.withColumn("distancia", F.when(F.col("src") == 2, F.raise_error(F.lit("roto")).cast("double")).otherwise(1.0))
    with pytest.raises(Exception, match="roto"), durable.trabajo(spark):
        paths.etiquetas(o, roto)
    # a loop that fails after its network has been stored
    with pytest.raises(ZeroDivisionError), durable.trabajo(spark):
        paths.etiquetas(o, e, podar=lambda a, b: 1 // 0)
    assert _quedan(spark) == antes


def test_sin_contar(spark):
    """A table that nobody wants counted is written and read back without a job for the count."""
    corte = durable.Corte(spark, "prueba")
    grupo = spark.sparkContext
    for contar, n in ((True, 5), (False, None)):
        grupo.setJobGroup(corte.nombre + str(contar), "")
        t, k = corte.guardar(spark.range(5), contar)
        grupo.setLocalProperty("spark.jobGroup.id", None)
        assert k == n and sorted(r.id for r in t.collect()) == [0, 1, 2, 3, 4]
    hechos = [len(grupo.statusTracker().getJobIdsForGroup(corte.nombre + x)) for x in ("True", "False")]
    assert hechos[1] < hechos[0]
    assert corte.avanzar(spark.range(5), contar=False)[1] is None
