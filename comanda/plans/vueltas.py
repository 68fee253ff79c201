"""Registered readers and writers: tables written by a sink and read back by its reader."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.functions import expr
from comanda.operators import grafo
from comanda.plans import almacen
from comanda.plans.durable import anotar, carpeta_compartida
from comanda.sources import guardadas, landing, sinks
from comanda.sources.derivadas import Dominio


def _nueva(d: Dominio) -> str:
    return anotar("ruta", f"{carpeta_compartida(d.spark)}/vuelta_{uuid.uuid4().hex}")


def _por_csv(d: Dominio, df: DataFrame, entidad: str) -> DataFrame:
    ruta = _nueva(d)
    sinks.escribir_csv(df, ruta)
    return landing.leer_csv(d.spark, ruta, entidad)


def restaurantes_csv(d: Dominio) -> DataFrame:
    columnas = ["id", "nombre", "capacidad", "categoria_local", "lat", "lon"]
    # the file has its columns in an order of its own
    return _por_csv(d, d.restaurantes.select(*reversed(columnas)), "restaurantes").select(
        *columnas, F.col("telefono").isNull().alias("sin_telefono"))


def menus_csv(d: Dominio) -> DataFrame:
    letra = F.when(F.col("activo"), "t").otherwise("f")
    return _por_csv(d, d.menus.withColumn("activo", letra), "menus")


def menus_dos_ordenes(d: Dominio) -> DataFrame:
    """Active menus in files of one column order, the others in another; titles have a line break."""
    ruta, columnas = _nueva(d), ["id", "titulo", "categoria", "activo", "restaurante_id"]
    m = d.menus.withColumn("titulo", F.concat_ws("\n", "titulo", "categoria")).select(*columnas)
    sinks.escribir_csv(m.filter("activo"), f"{ruta}/activos")
    sinks.escribir_csv(m.filter("NOT coalesce(activo, false)").select(*reversed(columnas)), f"{ruta}/otros")
    return landing.leer_csv(d.spark, f"{ruta}/*", "menus")


def documentos_fusionados(d: Dominio) -> DataFrame:
    """Search documents of the whole catalogue, and a later load of the active products over them."""
    ruta = _nueva(d)
    for menus, cuando in ((d.menus, "2024-01-31T02:00:00"), (d.menus.filter("activo"), "2024-02-01T02:00:00")):
        guardadas.fusionar(sinks.documentos_busqueda(menus, F.lit(cuando)), ruta, ["_id"])
    return guardadas.leer(d.spark, ruta)


def grafo_fusionado(d: Dominio) -> DataFrame:
    """Users and their orders loaded twice, the second time with the roles of one region: stored nodes and edges meet."""
    ruta = _nueva(d)
    pedidos = {"REALIZO": grafo.realizo(d.usuarios, d.pedidos_cabecera).select("src", "dst")}
    nodos = d.usuarios.select("id", "rol")
    guardadas.fusionar_grafo({"Usuario": nodos.withColumn("rol", F.lit("sin rol"))}, pedidos, ruta)
    guardadas.fusionar_grafo({"Usuario": d.usuarios.filter("pais = 'ASIA'").select("id", "rol")}, pedidos, ruta)
    por_usuario = (guardadas.leer(d.spark, f"{ruta}/aristas/REALIZO").groupBy(F.col("src").alias("id"))
                   .agg(F.count("*").alias("pedidos")))
    return (guardadas.leer(d.spark, f"{ruta}/nodos/Usuario").join(por_usuario, "id", "left")
            .select("id", "rol", F.coalesce("pedidos", F.lit(0)).cast("bigint").alias("pedidos")))


def detalle_opcional(d: Dominio) -> DataFrame:
    """An optional file that is there and one that is not."""
    ruta = _nueva(d)
    sinks.escribir_csv(d.pedido_detalle.drop("subtotal"), ruta)
    hay = landing.leer_csv(d.spark, ruta, "pedido_detalle", opcional=True)
    return hay.unionByName(landing.leer_csv(d.spark, f"{ruta}/falta", "pedido_detalle", opcional=True))


def usuarios_de_reparto(d: Dominio) -> DataFrame:
    """Users under the role and e-mail form of the delivery loader."""
    rol = F.when(F.col("rol") == "MACHINERY", "Cliente").otherwise(F.col("rol"))
    return d.usuarios.select("id", F.replace("email", F.lit("#"), F.lit("@")).alias("email"), rol.alias("rol"))


def pedidos_activos(d: Dominio) -> DataFrame:
    """Open orders of loaded customers and restaurants, status recoded."""
    codigo = F.expr("CASE estado WHEN 'pendiente' THEN 'PENDING' WHEN 'completado' THEN 'READY' ELSE 'CANCELLED' END")
    clientes = landing.clientes(usuarios_de_reparto(d))
    activos = landing.pedidos_activos(d.pedidos.withColumn("estado", codigo), clientes, d.restaurantes)
    # a ready order of this table is one on its way
    en_camino = F.when(F.col("estado") == "READY", "PICKED_UP").otherwise(F.col("estado"))
    return (activos.join(clientes.select(F.col("id").alias("usuario_id"), "nombre"), "usuario_id")
            .select("id", "nombre", F.col("items")[0].alias("item"), expr.recodificar_estado(en_camino).alias("estado")))


def estados(d: Dominio) -> DataFrame:
    """Every code of the feed, one that it does not know, and none."""
    codigo = F.element_at(F.array(*[F.lit(c) for c in (*expr.ESTADOS_PEDIDO, "LOST")], F.lit(None)),
                          (F.col("id") % 6 + 1).cast("int"))
    return d.pedidos_cabecera.select("id", expr.recodificar_estado(codigo).alias("estado"))


def _base_construida(d: Dominio) -> str:
    """Star tables in a database in the shared folder: declared first, then replaced twice."""
    base = anotar("DATABASE", f"comanda_vuelta_{uuid.uuid4().hex}")
    sinks.crear_base(d.spark, base, _nueva(d))
    sinks.crear_tablas(d.spark, base)
    almacen.construir_estrella(d.usuarios, d.restaurantes, d.menus, d.reservas, d.pedidos_cabecera, base=base)
    sinks.reemplazar_tabla(d.spark.table(f"{base}.hechos_reservas"), "hechos_copia", base)
    sinks.reemplazar_tabla(d.spark.table(f"{base}.hechos_reservas"), "hechos_copia", base)
    return base


def hechos_guardados(d: Dominio) -> DataFrame:
    return d.spark.table(f"{_base_construida(d)}.hechos_copia")


def cubo_guardado(d: Dominio) -> DataFrame:
    almacen.vistas_de_cubos(d.spark, _base_construida(d))
    return d.spark.table("cubo_ingresos_mes_categoria")


def mapa_xml(d: Dominio) -> DataFrame:
    """Road map as XML and the edges of its ways, with the name of the way."""
    raiz = _nueva(d)
    nodos = d.calle.select(F.col("id").alias("_id"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    fila = F.floor(F.col("id") / 40)
    nombre = F.when(F.col("_id") % 3 != 0, F.array(F.struct(
        F.lit("name").alias("_k"), F.concat(F.lit("Via "), F.col("_id").cast("string")).alias("_v"))))
    # a way is a row of the road grid: at most 40 nodes
    vias = (d.calle.groupBy(fila.alias("_id")).agg(F.sort_array(F.collect_list("id")).alias("n"))
            .select("_id", F.transform("n", lambda i: F.struct(i.cast("string").alias("_ref"))).alias("nd"),
                    nombre.alias("tag")))
    for parte, df, fila_xml in (("nodos", nodos, "node"), ("vias", vias, "way")):
        df.write.format("xml").option("rootTag", "osm").option("rowTag", fila_xml).save(f"{raiz}/{parte}")
    aristas = grafo.caminos_de_vias(landing.leer_vias_osm(d.spark, f"{raiz}/vias"),
                                    landing.leer_nodos_osm(d.spark, f"{raiz}/nodos"))
    return aristas.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"),
                          "distancia", "nombre")


def nombres_csv(d: Dominio) -> DataFrame:
    con_nombre = d.road.filter("nombre <> ''").selectExpr("src AS node_id", "nombre AS street_name")
    leidos = _por_csv(d, con_nombre, "nombres_calle")
    return grafo.actualizar_nombres(d.calle, leidos.withColumn("node_id", F.col("node_id").cast("bigint")))


def catalogo_reciente(d: Dominio) -> DataFrame:
    cuando = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, CAST(id % 48 AS INT))")
    reciente = landing.catalogo_reciente(d.menus.withColumn("updated_at", cuando),
                                         F.expr("timestamp_ntz'2024-01-02 12:00:00'"))
    return reciente.select("id", "titulo")


def grafo_guardado(d: Dominio) -> DataFrame:
    """Rows of each stored label and edge type, after a load that replaced an earlier one."""
    raiz = _nueva(d)
    nodos = {"Usuario": d.usuarios, "Restaurante": d.restaurantes, "Producto": d.menus}
    aristas = {"REALIZO": grafo.realizo(d.usuarios, d.pedidos_cabecera)}
    sinks.escribir_grafo({"Usuario": d.calle}, {}, raiz)
    sinks.escribir_grafo(nodos, aristas, raiz)
    leer = d.spark.read.parquet
    return grafo.conteo_por_tipo("tipo", **{n: leer(f"{raiz}/nodos/{n}") for n in nodos},
                                 **{n: leer(f"{raiz}/aristas/{n}") for n in aristas})


def marcas_de_tiempo(d: Dominio) -> DataFrame:
    """Timestamp from a date and an hour column, some of them dirty."""
    ts = F.col("timestamp_reserva")
    hora = F.when(F.col("id") % 13 == 0, "xx").otherwise(F.date_format(ts, "HH:mm:ss"))
    marca = expr.marca_tiempo(F.date_format(ts, "yyyy-MM-dd"), hora)
    return (d.reservas_cabecera.filter("timestamp_reserva IS NOT NULL")
            .select("id", F.date_format(marca, "yyyy-MM-dd HH:mm:ss").alias("cuando")))


def centimos(d: Dominio) -> DataFrame:
    """Prices in eighths, to cents: halves go up."""
    octavos: Column = F.col("cantidad") / F.lit(8.0)
    return d.pedido_detalle.select("pedido_id", "producto_id", expr.redondeo_dinero(octavos).alias("precio"))


def consultas() -> dict[str, Callable[[Dominio], DataFrame]]:
    return {
        "s01_restaurantes_csv": restaurantes_csv,
        "s02_menus_csv": menus_csv,
        "s02_menus_dos_ordenes": menus_dos_ordenes,
        "s03_detalle_opcional": detalle_opcional,
        "s04_clientes_limitados": lambda d: landing.clientes(usuarios_de_reparto(d), 500).select("id", "nombre"),
        "s05_hechos_guardados": hechos_guardados,
        "s08_mapa_xml": mapa_xml,
        "s09_nombres_csv": nombres_csv,
        "s10_catalogo_reciente": catalogo_reciente,
        "j09_pedidos_activos": pedidos_activos,
        "k05_cubo_guardado": cubo_guardado,
        "k06_documentos_fusionados": documentos_fusionados,
        "k08_grafo_fusionado": grafo_fusionado,
        "k07_grafo_guardado": grafo_guardado,
        "p07_estados": estados,
        "p09_listado_restaurantes": lambda d: d.restaurantes.select("id", "nombre", "lat", "lon").orderBy("id"),
        "p09_listado_clientes": lambda d: d.clientes.select("id", F.col("email").alias("nombre"), "lat", "lon").orderBy("id"),
        "x01_marcas_de_tiempo": marcas_de_tiempo,
        "x10_centimos": centimos,
    }
