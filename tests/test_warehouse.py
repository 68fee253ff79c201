import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from comanda.functions import expr, geo
from comanda.operators import cubes, dashboards as tab, grafo, quality, star, summaries
from comanda.plans import almacen
from comanda.sources import landing, sinks
from comanda.sources.derivadas import Dominio
from comanda.streaming import tiempo_real
from tests.conftest import filas

MENUS = "id,titulo,categoria,activo,restaurante_id\n1,Sopa,Entrada,t,1\n2,Flan,Postre,f,1\n3,Pollo,Plato Fuerte,t,2\nx,Mal,Postre,t,2\n"
REST = ('id,nombre,direccion,telefono,capacidad,categoria_local,lat,lon\n1,Uno,"Calle 1, San José",55,40,casual,9.86,-83.91\n'
        "2,Dos,Sur,56,20,gourmet,9.87,-83.92\n")
USU = "id,email,rol,fecha_alta\n1,ana@x.com,Cliente,2024-01-05 10:00:00\n2,leo@x.com,Admin,2024-01-06 10:00:00\n"
PED = ("id,menu_id,total,estado,restaurante_id,usuario_id,fecha_creacion\n1,1,10.5,PENDING,1,1,2024-02-01 12:30:00\n"
       "2,3,0,READY,2,1,2024-02-01 13:00:00\n3,2,7.25,CANCELLED,1,2,2024-03-01 09:00:00\n4,1,99,,1,9,2024-03-02 09:00:00\n")
RES = ("id,usuario_id,restaurante_id,menu_id,pedido_id,fecha,hora,estado,invitados\n1,1,1,1,1,2024-02-01,12:00:00,ACTIVE,2\n"
       "2,1,2,3,2,2024-02-01,13:00:00,ACTIVE,4\n3,2,1,2,3,2024-04-02,09:30:00,CANCELLED,60\n4,2,1,1,,2024-04-02,09:30:00,ACTIVE,1\n"
       "5,2,1,1,4,mala,,ACTIVE,1\n")


@pytest.fixture(scope="module")
def tablas(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("csv")
    for n, t in dict(menus=MENUS, restaurantes=REST, usuarios=USU, pedidos=PED, reservas=RES).items():
        (d / f"{n}.csv").write_text(t)
    return {n: landing.leer_csv(spark, f"{d}/{n}.csv", n) for n in ("menus", "restaurantes", "usuarios", "pedidos", "reservas")} | {"_d": d}


def test_csv_de_varios_ordenes(spark, tmp_path):
    """A folder of files with their columns in different orders, a quoted line break, a column more, one less, no line."""
    d = tmp_path / "con blanco"
    d.mkdir()
    (d / "a.csv").write_text('id,titulo,categoria,activo,restaurante_id\n1,"Sopa ""del\ndía""",x,t,7\nmala,"a\nb",x,f,8\n')
    (d / "b.csv").write_text('restaurante_id,activo,id,titulo,categoria\n9,f,2,Pan,y\n')
    (d / "c.csv").write_text('titulo,id,otra\nTé,3,z\n')
    (d / "d.csv").write_text('id,titulo,categoria,activo,restaurante_id\n4,Flan,x,t,7,de más\n5,Uva\n6,Kiwi,x,quizás,7\n')
    (d / "e.csv").write_text("")
    f = landing.leer_csv(spark, str(d), "menus", con_corruptas=True)
    assert sorted(map(repr, (tuple(r) for r in f.drop("_corrupt_record").collect()))) == sorted(map(repr, [
        (1, 'Sopa "del\ndía"', "x", True, 7), (None, "a\nb", "x", False, 8), (2, "Pan", "y", False, 9), (3, "Té", None, None, None),
        (4, "Flan", "x", True, 7), (5, "Uva", None, None, None), (6, "Kiwi", "x", None, 7)]))
    assert filas(f.filter("_corrupt_record IS NOT NULL"), "_corrupt_record") == [("6,Kiwi,x,quizás,7",), ('mala,"a\nb",x,f,8',)]
    sin = landing.leer_csv(spark, str(d), "menus")
    assert sin.columns == f.columns[:-1] and sin.count() == 7 and len(landing.indice_de_cabeceras(spark, str(d))) == 3
    (tmp_path / "nada").mkdir()
    (tmp_path / "nada" / "x.csv").write_text("")
    assert landing.leer_csv(spark, str(tmp_path / "nada"), "menus").isEmpty()


def test_csv_con_tipos(spark, tablas):
    assert filas(tablas["menus"].filter("id IS NOT NULL"), "id", "activo") == [(1, True), (2, False), (3, True)]
    assert tablas["restaurantes"].first().direccion == "Calle 1, San José"
    mal = landing.leer_csv(spark, f"{tablas['_d']}/menus.csv", "menus", con_corruptas=True).filter("_corrupt_record IS NOT NULL")
    assert mal.first()._corrupt_record in MENUS.splitlines() and mal.first()._corrupt_record.startswith("x,")
    vacia = landing.leer_csv(spark, f"{tablas['_d']}/falta.csv", "pedido_detalle", opcional=True)
    assert vacia.isEmpty() and vacia.columns == ["pedido_id", "producto_id", "cantidad", "precio_unitario"]


def test_cargas_del_reparto(tablas):
    c = landing.clientes(tablas["usuarios"])
    assert filas(c, "id", "nombre") == [(1, "ana")]
    assert landing.clientes(tablas["usuarios"].filter("id > 1"), 1).isEmpty()
    activos = landing.pedidos_activos(tablas["pedidos"], c, tablas["restaurantes"])
    assert filas(activos, "id", "items") == [(1, ["Item_1"]), (2, ["Item_3"])]
    assert filas(landing.pedidos_activos(tablas["pedidos"], c, tablas["restaurantes"], 1), "id") == [(1,)]


def test_estrella_y_analisis(spark, tablas):
    base = "dw_prueba"
    t = [tablas[n] for n in ("usuarios", "restaurantes", "menus", "reservas", "pedidos")]
    for _ in range(2):                                               # a rebuild replaces everything
        almacen.construir_estrella(*t, base=base)
    h = spark.table(f"{base}.hechos_reservas")
    assert h.count() == 4                                            # the row without timestamp is dropped
    assert {f.name for f in h.schema} == {"tiempo_id", "usuario_id", "restaurante_id", "menu_id", "total", "estado_reserva",
                                          "estado_pedido", "invitados"}
    assert spark.table(f"{base}.dim_tiempo").count() == 3
    assert h.join(spark.table(f"{base}.dim_tiempo"), "tiempo_id", "left_anti").isEmpty()
    nombres = almacen.analisis(spark, base)
    assert len(nombres) == 5 and filas(spark.table(f"{base}.dw_horarios_pico")) == [(9, 2), (12, 1), (13, 1)]
    almacen.vistas_de_cubos(spark, base)
    assert filas(spark.table("cubo_frecuencia_menu")) == [("Flan", 1), ("Pollo", 1), ("Sopa", 2)]
    assert filas(spark.table("cubo_estado_pedido_mes").filter("estado_pedido IS NULL"), "cantidad") == [(1,)]


def test_vistas_de_tablero(spark, carpeta):
    d = Dominio(spark, carpeta)
    almacen.vistas_de_tablero(d.pedidos, d.reservas, d.usuarios, d.menus, d.restaurantes)
    assert spark.sql("SELECT * FROM v_top_productos_ingresos").count() == 20
    assert spark.sql("SELECT SUM(porcentaje_total) AS p FROM v_estadisticas_pedidos").first().p == pytest.approx(100, abs=0.02)


def test_clave_de_tiempo_igual_que_dimension(spark, carpeta):
    d = Dominio(spark, carpeta)
    h = star.hechos_reservas(d.reservas, d.pedidos_cabecera)
    dim = star.dim_tiempo(d.reservas)
    for f, extra in ((cubes.tendencias_consumo, [star.dim_menu(d.menus)]), (cubes.crecimiento_mensual_detalle, []),
                     (cubes.horarios_pico_detalle, [])):
        assert filas(f(h, *extra)) == filas(f(h, *extra, tiempo=dim))
    fp = tab.fact_pedidos(d.pedidos)
    assert filas(tab.rendimiento_horario(fp)) == filas(tab.rendimiento_horario(fp, tab.dim_tiempo(d.pedidos)))


def test_crecimiento(spark):
    meses = spark.createDataFrame([(2024, 1, 100.0), (2024, 2, 0.0), (2024, 4, 50.0), (2024, 5, 75.0)], "a int, m int, total double")
    h = meses.select(F.unix_micros(F.make_timestamp("a", "m", F.lit(1), F.lit(0), F.lit(0), F.lit(0))).alias("tiempo_id"), "total",
                     F.lit(1).alias("usuario_id"))
    r = cubes.crecimiento_mensual(h).collect()
    assert [(x.mes, x.ingresos_prev, x.porcentaje_crecimiento) for x in r] == [
        (1, None, 0.0), (2, 100.0, -100.0), (4, 0.0, None), (5, 50.0, 50.0)]
    assert [x.porcentaje_crecimiento for x in cubes.crecimiento_mensual_detalle(h).collect()] == [None, -100.0, None, 50.0]


def test_empates_en_el_corte(spark):
    fp = spark.createDataFrame([(i, i, 1, 1, 10.0, "completado") for i in range(6)] + [(9, 9, 1, 1, 50.0, "completado")],
                               "id_pedido long, id_menu long, id_restaurante long, id_usuario long, precio_total double, estado string")
    m = spark.createDataFrame([(i, f"t{i}", "c") for i in range(10)], "id_menu long, titulo string, categoria string")
    r = spark.createDataFrame([(1, "r", "x")], "id_restaurante long, nombre string, ciudad string")
    top = tab.top_productos_ingresos(fp, m, r, 3).collect()
    assert [(x.producto, x.ranking) for x in top] == [("t9", 1), ("t0", 2), ("t1", 2)]


def test_multiplicacion_por_usuario(spark):
    u = spark.createDataFrame([(1, "C", "P", 20), (2, "C", "P", 30), (3, "C", "P", 40)], "id_usuario long, ciudad string, pais string, edad int")
    fp = spark.createDataFrame([(1, 1, 10.0), (2, 1, 20.0), (3, 2, 5.0)], "id_pedido long, id_usuario long, precio_total double")
    fr = spark.createDataFrame([(1, 1, 2), (2, 1, 4), (3, 1, None), (4, 3, 8)], "id_reserva long, id_usuario long, numero_personas int")
    assert filas(tab.actividad_zona_geografica(u, fp, fr)) == [("C", "P", 3, 7, 95.0, 95 / 7, 7, 4.0)]
    assert filas(tab.actividad_zona_geografica(u, fp, fr, True)) == [("C", "P", 3, 3, 35.0, 35 / 3, 4, 4.67)]


def test_calidad(tablas):
    h = star.hechos_reservas(tablas["reservas"], tablas["pedidos"])
    r = quality.informe({"hechos_reservas": h, "dim_usuario": star.dim_usuario(tablas["usuarios"])},
                        {n: tablas[n] for n in ("usuarios", "pedidos", "reservas")})
    por = {(x.control, x.tabla, x.columna): (x.observado, x.correcto) for x in r.collect()}
    assert por["huerfanos", "pedidos", "id"] == (0, True)
    assert por["minimo", "dim_usuario", ""] == (2, False)
    assert por["rango", "hechos_reservas", "invitados"] == (1, False)
    assert por["rango", "hechos_reservas", "total"] == (0, True)
    quality.exigir(r)
    with pytest.raises(ValueError, match="vacia"):
        quality.exigir(quality.no_vacias(vacia=tablas["usuarios"].filter("id < 0")))


def test_extractos(tablas):
    r = star.reservas_completas(tablas["reservas"], tablas["pedidos"], F.lit("2024-03-15").cast("date"))
    assert filas(r, "reserva_id", "total", "estado_pedido") == [(3, 7.25, "CANCELLED"), (4, 0.0, "sin_pedido")]
    assert filas(star.menus_activos(tablas["menus"], tablas["restaurantes"]), "titulo") == [("Mal",), ("Pollo",), ("Sopa",)]


def test_expresiones(spark):
    d = spark.createDataFrame([("PENDING", 24, "a@b"), ("PICKED_UP", 25, "x"), ("otro", 99, "@"), (None, 17, None)],
                              "e string, edad int, email string")
    assert [tuple(r) for r in d.select(expr.recodificar_estado(F.col("e")), expr.grupo_edad(F.col("edad")),
                                       expr.nombre_de_email(F.col("email"))).collect()] == [
        ("pendiente", "18-24", "a"), ("en_ruta", "25-34", "x"), ("pendiente", "55+", ""), ("pendiente", "18-24", None)]
    m = spark.createDataFrame([(0.0,), (1.0,), (1000.0,), (25000.0,)], "m double")
    assert [r[0] for r in m.select(geo.minutos_viaje(F.col("m"))).collect()] == [0, 1, 2, 60]
    p = [F.lit(x) for x in (9.86, -83.92, 9.9, -83.8)]
    a, b = spark.range(1).select(geo.haversine_m(*p), geo.haversine_m(*p[2:], *p[:2])).first()
    assert a == pytest.approx(b) and 13_000 < a < 15_000


def test_osm(spark, tmp_path):
    f = tmp_path / "mapa.osm"
    f.write_text('<osm><node id="1" lat="9.0" lon="-83.0"/><node id="2" lat="9.001" lon="-83.0"/>'
                 '<node id="3" lat="9.001" lon="-83.002"/><way id="7"><nd ref="1"/><nd ref="2"/><nd ref="3"/>'
                 '<tag k="name" v="Av 1"/></way><way id="8"><nd ref="3"/><tag k="a" v="b"/><tag k="c" v="d"/></way>'
                 '<way id="9"><nd ref="2"/><nd ref="1"/></way></osm>')
    nodos, vias = landing.leer_nodos_osm(spark, str(f)), landing.leer_vias_osm(spark, str(f))
    assert filas(vias.filter("nombre IS NOT NULL"), "id", "nombre") == [("7", "Av 1")]
    e = {(a, b): d for a, b, d in filas(grafo.caminos_de_vias(vias, nodos), "src", "dst", "distancia")}
    assert set(e) == {("1", "2"), ("2", "1"), ("2", "3"), ("3", "2")}
    assert e["1", "2"] == pytest.approx(111.0) and e["2", "3"] == pytest.approx(222.0)


def test_grafo(spark, tablas):
    lineas = spark.createDataFrame([(1, 1, 2, 5.0), (1, 1, 2, 5.0), (1, 3, 1, 4.0), (8, 1, 1, 1.0)],
                                   "pedido_id long, producto_id long, cantidad int, precio_unitario double")
    d = grafo.incluye_detalle(lineas, tablas["pedidos"], tablas["menus"])
    assert filas(d, "src", "dst", "subtotal") == [(1, 1, 10.0), (1, 3, 4.0)]          # repeated line, unknown order
    assert filas(summaries.estadisticas_cesta(d, tablas["pedidos"])) == [(2, 1, 4, 2.0)]
    assert filas(grafo.realizo(tablas["usuarios"], tablas["pedidos"])) == [(1, 1), (1, 2), (2, 3)]
    assert grafo.reservo(tablas["reservas"], tablas["usuarios"], tablas["restaurantes"]).count() == 5
    nodos = spark.createDataFrame([(1, None), (2, "viejo"), (3, "")], "id long, nombre string")
    nuevos = spark.createDataFrame([(1, "uno"), (9, "nadie")], "node_id long, street_name string")
    assert filas(grafo.actualizar_nombres(nodos, nuevos), "id", "nombre") == [(1, "uno"), (2, "viejo"), (3, "")]
    e = spark.createDataFrame([(1, 2, None), (2, 4, "x"), (4, 5, "")], "src long, dst long, nombre string")
    assert filas(grafo.conectados_aislados(nodos, e)) == [("AISLADO", 1), ("CONECTADO", 2)]
    assert filas(grafo.estadisticas_nombres(e)) == [(6, 2, 4, 33.33)]


def test_documentos_y_archivos(spark, tablas, tmp_path):
    m = tablas["menus"].filter("id IS NOT NULL")
    doc = sinks.documentos_busqueda(m.unionByName(m), F.lit("2024-01-01T00:00:00"))
    uno = {r._id: json.loads(r.doc) for r in doc.collect()}
    assert len(uno) == 3 and uno[1] == {"id": 1, "titulo": "Sopa", "categoria": "Entrada", "activo": True, "restaurante_id": 1,
                                        "updated_at": "2024-01-01T00:00:00"}
    sinks.escribir_documentos(doc, f"{tmp_path}/docs")
    assert spark.read.json(f"{tmp_path}/docs").count() == 3
    sinks.escribir_csv(m.select("id", "titulo"), f"{tmp_path}/csv")
    assert filas(spark.read.option("header", True).csv(f"{tmp_path}/csv"), "id") == [("1",), ("2",), ("3",)]
    sinks.escribir_grafo({"Producto": m}, {}, f"{tmp_path}/g")
    assert spark.read.parquet(f"{tmp_path}/g/nodos/Producto").count() == 3
    ahora = dt.datetime(2024, 1, 2)
    fechado = m.withColumn("updated_at", F.when(F.col("id") == 1, F.lit(dt.datetime(2024, 1, 1, 12))).otherwise(F.lit(dt.datetime(2023, 1, 1))))
    assert filas(landing.catalogo_reciente(fechado, ahora), "id") == [(1,)]


def test_tablas_declaradas(spark):
    sinks.crear_base(spark, "dw_declarado")
    sinks.crear_tablas(spark, "dw_declarado")
    sinks.crear_tablas(spark, "dw_declarado")
    assert spark.table("dw_declarado.dim_menu").columns == ["menu_id", "titulo_menu", "categoria_menu", "activo", "restaurante_id"]


def test_flujo_igual_que_lote(spark, carpeta, tmp_path):
    ev = spark.read.parquet(f"{carpeta}/events.parquet").select(F.col("ts").cast("timestamp").alias("timestamp_reserva"))
    ev.repartition(3).write.parquet(f"{tmp_path}/ev")
    flujo = spark.readStream.schema(ev.schema).parquet(f"{tmp_path}/ev")
    q = (tiempo_real.reservas_por_hora(flujo).writeStream.outputMode("complete").format("memory").queryName("por_hora")
         .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start())
    q.awaitTermination(120)
    esperado = ev.groupBy(F.hour("timestamp_reserva").alias("hora")).agg(F.count("*").alias("n"))
    assert filas(tiempo_real.horarios_pico(spark.table("por_hora"))) == filas(esperado)
