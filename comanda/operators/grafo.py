"""Property graph as one node frame per label and one edge frame per type, and its statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.functions.expr import no_vacio, porcentaje
from comanda.functions.geo import plana_m
from comanda.operators.summaries import conteo, una_fila


# ---- edges ---------------------------------------------------------------------------------

def _arista(df: DataFrame, src: str, dst: str, desde: DataFrame, hasta: DataFrame, fusionar: bool,
            **props: Column) -> DataFrame:
    """Edges whose two endpoints exist.  ``fusionar`` keeps one edge per endpoints and properties."""
    e = df.select(F.col(src).alias("src"), F.col(dst).alias("dst"), *[c.alias(n) for n, c in props.items()])
    e = e.filter("src IS NOT NULL AND dst IS NOT NULL")
    # an end that is the frame's own key exists
    if not (df is desde and src == "id"):
        e = e.join(desde.select(F.col("id").alias("src")), "src", "left_semi")
    if not (df is hasta and dst == "id"):
        e = e.join(hasta.select(F.col("id").alias("dst")), "dst", "left_semi")
    e = e.select("src", "dst", *props)
    return e.distinct() if fusionar else e


def realizo(usuarios: DataFrame, pedidos: DataFrame) -> DataFrame:
    return _arista(pedidos, "usuario_id", "id", usuarios, pedidos, True)


def en_restaurante(pedidos: DataFrame, restaurantes: DataFrame) -> DataFrame:
    return _arista(pedidos, "id", "restaurante_id", pedidos, restaurantes, True)


def incluye(pedidos: DataFrame, productos: DataFrame) -> DataFrame:
    return _arista(pedidos, "id", "menu_id", pedidos, productos, True)


def incluye_detalle(detalle: DataFrame, pedidos: DataFrame, productos: DataFrame) -> DataFrame:
    """Basket lines; repeated identical lines of an order become one edge."""
    if "subtotal" not in detalle.columns:
        detalle = detalle.withColumn("subtotal", F.col("cantidad") * F.col("precio_unitario"))
    return _arista(detalle, "pedido_id", "producto_id", pedidos, productos, True, cantidad=F.col("cantidad"),
                   precio_unitario=F.col("precio_unitario"), subtotal=F.col("subtotal"))


def reservo(reservas: DataFrame, usuarios: DataFrame, restaurantes: DataFrame) -> DataFrame:
    """One edge per reservation, repeated ones included."""
    if "fecha" in reservas.columns:
        fecha, hora = F.to_date("fecha"), F.col("hora")
    else:
        fecha = F.to_date("timestamp_reserva")
        hora = F.date_format("timestamp_reserva", "HH:mm:ss")
    return _arista(reservas, "usuario_id", "restaurante_id", usuarios, restaurantes, False,
                   fecha=fecha, hora=hora, invitados=F.col("invitados"), estado=F.col("estado"))


def simetrica(aristas: DataFrame) -> DataFrame:
    """Every edge in both directions."""
    props = [c for c in aristas.columns if c not in ("src", "dst")]
    inversa = aristas.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *props)
    return aristas.select("src", "dst", *props).unionByName(inversa)


def caminos_de_vias(vias: DataFrame, nodos: DataFrame) -> DataFrame:
    """Road edges from ways (``nd``: ordered node ids): consecutive nodes, planar metres, both
    directions, one edge per endpoints and length.  Named ways (``nombre``) give named edges."""
    nombre = [c for c in vias.columns if c == "nombre"]
    pares = (vias.filter(F.size("nd") > 1)
             .select(F.explode(F.arrays_zip(F.expr("slice(nd, 1, size(nd) - 1)").alias("src"),
                                            F.expr("slice(nd, 2, size(nd) - 1)").alias("dst"))).alias("p"), *nombre)
             .select("p.src", "p.dst", *nombre).distinct())
    a = nodos.select(F.col("id").alias("src"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    b = nodos.select(F.col("id").alias("dst"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    metros = plana_m(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    return simetrica(pares.join(a, "src").join(b, "dst")
                     .select("src", "dst", metros.alias("distancia"), *nombre)).distinct()


def actualizar_nombres(nodos: DataFrame, nombres: DataFrame) -> DataFrame:
    """Sets ``nombre`` on the nodes named in (node_id, street_name); unknown ids are ignored."""
    if "nombre" not in nodos.columns:
        nodos = nodos.withColumn("nombre", F.lit(None).cast("string"))
    ultimo = nombres.groupBy(F.col("node_id").alias("id")).agg(F.max("street_name").alias("_nuevo"))
    return (nodos.join(ultimo, "id", "left")
            .withColumn("nombre", F.coalesce("_nuevo", "nombre")).drop("_nuevo"))


# ---- counts --------------------------------------------------------------------------------

def conteo_por_tipo(columna: str, **tablas: DataFrame) -> DataFrame:
    """Rows per node label or edge type."""
    partes = [df.agg(F.count("*").alias("cantidad")).select(F.lit(t).alias(columna), "cantidad")
              for t, df in tablas.items()]
    return (reduce(DataFrame.unionByName, partes).filter("cantidad > 0")
            .orderBy(F.desc("cantidad"), columna))


def estadisticas_grafo(usuarios: DataFrame, restaurantes: DataFrame, productos: DataFrame, pedidos: DataFrame,
                       calles: DataFrame, aristas: list[DataFrame]) -> DataFrame:
    """One row of counts; a label without nodes counts 0."""
    total = reduce(lambda a, b: a + b, [conteo(e) for e in aristas])
    return una_fila(usuarios, usuarios=conteo(usuarios), restaurantes=conteo(restaurantes),
                    productos=conteo(productos), pedidos=conteo(pedidos), calles=conteo(calles),
                    total_relaciones=total)


def estadisticas_vial(nodos: DataFrame, aristas: DataFrame, restaurantes: DataFrame, clientes: DataFrame) -> DataFrame:
    """Road-system counts; each stored edge is seen from both of its ends."""
    return una_fila(nodos, nodos_osm=conteo(nodos), relaciones_osm=conteo(aristas) * 2,
                    restaurantes=conteo(restaurantes), clientes=conteo(clientes))


# ---- degree and connectivity ---------------------------------------------------------------

def grados(aristas: DataFrame) -> DataFrame:
    """Edge ends per node, ends counted before the shuffle."""
    return (aristas.select(F.explode(F.array("src", "dst")).alias("id"))
            .groupBy("id").agg(F.count("*").alias("conexiones")))


def cruces_principales(nodos: DataFrame, aristas: DataFrame, k: int = 10) -> DataFrame:
    mejores = nodos.join(grados(aristas), "id")
    return mejores.orderBy(F.desc("conexiones"), "id").limit(k).select("id", "lat", "lon", "conexiones")


def _estado(conexiones: Column) -> Column:
    return F.when(conexiones > 0, "CONECTADO").otherwise("AISLADO")


def con_conexiones(nodos: DataFrame, aristas: DataFrame) -> DataFrame:
    """Nodes with their edge count (0 when isolated) and state."""
    return (nodos.join(grados(aristas), "id", "left")
            .withColumn("conexiones", F.coalesce("conexiones", F.lit(0).cast("bigint")))
            .withColumn("estado", _estado(F.col("conexiones"))))


def conectados_aislados(nodos: DataFrame, aristas: DataFrame) -> DataFrame:
    return (con_conexiones(nodos.select("id"), aristas).groupBy("estado")
            .agg(F.count("*").alias("cantidad")).orderBy("estado"))


def conectividad_anclas(anclas: DataFrame, nodos: DataFrame, aristas: DataFrame) -> DataFrame:
    """Anchors (id, nombre, osm_node_id) with the connectivity of their road node."""
    n = con_conexiones(nodos.select("id"), aristas).withColumnRenamed("id", "osm_node_id")
    return anclas.join(n, "osm_node_id").select("id", "nombre", "osm_node_id", "conexiones", "estado")


def anclas_con_nodo(anclas: DataFrame, nodos: DataFrame) -> DataFrame:
    """Anchors with the coordinates of their road node."""
    n = nodos.select(F.col("id").alias("osm_node_id"), F.col("lat").alias("osm_lat"), F.col("lon").alias("osm_lon"))
    return anclas.join(n, "osm_node_id").select("id", "nombre", "lat", "lon", "osm_node_id", "osm_lat", "osm_lon")


# ---- street names --------------------------------------------------------------------------
# An undirected pattern meets every stored edge once from each end, hence the factor 2.

def calles_frecuentes(aristas: DataFrame, k: int = 10) -> DataFrame:
    return (aristas.filter(no_vacio(F.col("nombre"))).groupBy(F.col("nombre").alias("calle"))
            .agg((F.count("*") * 2).alias("frecuencia")).orderBy(F.desc("frecuencia"), "calle").limit(k))


def calles_distintas(aristas: DataFrame, k: int = 20) -> DataFrame:
    return (aristas.filter(no_vacio(F.col("nombre"))).select(F.col("nombre").alias("calle"))
            .distinct().orderBy("calle").limit(k))


def estadisticas_nombres(aristas: DataFrame) -> DataFrame:
    con = F.coalesce(no_vacio(F.col("nombre")), F.lit(False))
    return (aristas.agg((F.count("*") * 2).alias("total_relaciones"), (F.count_if(con) * 2).alias("con_nombre"),
                        (F.count_if(~con) * 2).alias("sin_nombre"))
            .withColumn("porcentaje_con_nombre", porcentaje(F.col("con_nombre"), F.col("total_relaciones"))))


# ---- rankings ------------------------------------------------------------------------------

def restaurantes_populares(restaurantes: DataFrame, aristas_restaurante: DataFrame, categoria: str | None = None,
                           k: int = 10) -> DataFrame:
    """Orders per restaurant.  The category restricts which orders count, not which restaurants
    are listed, so restaurants of other categories stay with 0."""
    n = aristas_restaurante.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("n"))
    cuenta = F.coalesce("n", F.lit(0).cast("bigint"))
    if categoria is not None:
        cuenta = F.when(F.col("categoria_local") == categoria, cuenta).otherwise(F.lit(0).cast("bigint"))
    return (restaurantes.join(n, "id", "left")
            .select("nombre", F.col("categoria_local").alias("categoria"), cuenta.alias("total"), "id")
            .orderBy(F.desc("total"), "id").limit(k).select("nombre", "categoria", "total"))


def actividad_usuarios(usuarios: DataFrame, aristas_pedido: DataFrame, k: int = 10) -> DataFrame:
    n = aristas_pedido.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("actividad"))
    return (usuarios.join(n, "id").orderBy(F.desc("actividad"), "id").limit(k)
            .select("email", "rol", "actividad"))


