import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from comanda.session import crear_sesion  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    raiz = tmp_path_factory.mktemp("spark")
    s = crear_sesion("local[8]", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(raiz / "warehouse"), "spark.checkpoint.dir": str(raiz / "cortes")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def carpeta():
    return "/root/testdata/sf0.001"


def filas(df, *columnas):
    """Rows as sorted tuples."""
    return sorted(tuple(r) for r in (df.select(*columnas) if columnas else df).collect())
