"""Recommendation and influence networks between users."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.expr import cociente
from comanda.operators.copurchase import cestas, pares_de_productos
from comanda.operators.similarity import Similitud
from comanda.plans.durable import Corte
from comanda.plans.pares import unir_por_clave


# ---- recommendations (src, dst, canal[, fecha]) --------------------------------------------

def ranking_recomendaciones(recomienda: DataFrame, usuarios: DataFrame, lado: str = "src", k: int = 10) -> DataFrame:
    """Users with most recommendations made (``src``) or received (``dst``) and their channels
    as (canal, cantidad), which holds the whole list however long it is."""
    por_canal = recomienda.groupBy(F.col(lado).alias("id"), "canal").agg(F.count("*").alias("cantidad"))
    mejores = (por_canal.groupBy("id").agg(F.sum("cantidad").alias("total"))
               .join(usuarios.select("id", "email", "rol"), "id").orderBy(F.desc("total"), "id").limit(k))
    canales = (por_canal.join(F.broadcast(mejores.select("id")), "id", "left_semi").groupBy("id")
               .agg(F.sort_array(F.collect_list(F.struct("canal", "cantidad"))).alias("canales")))
    return mejores.join(canales, "id").orderBy(F.desc("total"), "id").select("id", "email", "rol", "total", "canales")


def estadisticas_recomendacion(recomienda: DataFrame) -> DataFrame:
    """One row: edges, distinct senders and receivers, and the channel histogram."""
    por_canal = recomienda.groupBy("canal").agg(F.count("*").alias("cantidad"))
    return por_canal.agg(
        F.coalesce(F.sum("cantidad"), F.lit(0)).alias("total_recomendaciones"),
        F.sort_array(F.collect_list(F.struct("canal", "cantidad"))).alias("distribucion_canales"),
    ).select("total_recomendaciones",
             recomienda.agg(F.count_distinct("src")).scalar().alias("usuarios_que_recomiendan"),
             recomienda.agg(F.count_distinct("dst")).scalar().alias("usuarios_recomendados"),
             "distribucion_canales")


def mutuas(recomienda: DataFrame) -> DataFrame:
    """Users that recommend each other, once from each side; ``veces`` counts edge pairs."""
    m = recomienda.groupBy("src", "dst").agg(F.count("*").alias("n"))
    ida = m.select(F.col("src").alias("usuario1"), F.col("dst").alias("usuario2"), F.col("n").alias("n1"))
    vuelta = m.select(F.col("dst").alias("usuario1"), F.col("src").alias("usuario2"), F.col("n").alias("n2"))
    mismo = F.col("usuario1") == F.col("usuario2")
    veces = F.when(mismo, F.col("n1") * (F.col("n1") - 1)).otherwise(F.col("n1") * F.col("n2"))
    return (ida.join(vuelta, ["usuario1", "usuario2"])
            .select("usuario1", "usuario2", veces.alias("veces")).filter("veces > 0"))


def mutuas_con_email(pares: DataFrame, usuarios: DataFrame) -> DataFrame:
    """Replaces the user ids of ``mutuas`` by e-mails."""
    for lado in ("usuario1", "usuario2"):
        u = usuarios.select(F.col("id").alias(lado), F.col("email").alias(f"email{lado[-1]}"))
        pares = pares.join(u, lado)
    return pares.select("email1", "email2", "veces")


def cadenas(recomienda: DataFrame, minimo: int = 1, maximo: int = 3, k: int = 10) -> DataFrame:
    """The k longest recommendation chains whose ends differ and that use no edge twice, in order of length (longest
    first), user ids, channels and dates: (nodos, canales, fechas, chain_length).  Without a column ``fecha``, dates are null.

    From all edges it is computed which steps between two users can be followed by enough others.  Ways of users are then
    made step by step; since each one can be completed, only the first k after each step can be among the first k
    in the end, so a user with very many ways is never expanded beyond k.  More ways follow only where those that use an
    edge twice or close on their start left fewer than k chains.
    """
    corte = Corte(recomienda.sparkSession, "cadenas")
    fecha = F.col("fecha") if "fecha" in recomienda.columns else F.lit(None).cast("date")
    e, _ = corte.guardar(recomienda.select("src", "dst", "canal", fecha.alias("fecha"),
                                           F.monotonically_increasing_id().alias("arista")))
    # of parallel edges a chain among the k first uses one of so many: the others give k chains before it
    en_orden = W.partitionBy("src", "dst").orderBy("canal", "fecha", "arista")
    aristas, _ = corte.guardar(e.withColumn("_r", F.row_number().over(en_orden)).filter(F.col("_r") < k + maximo).drop("_r"))
    # tramos[m]: steps that m - 1 further ones can follow; inicios[m]: their distinct first users
    tramos, inicios = [corte.guardar(e.select("src", "dst").distinct())[0]], []
    for m in range(maximo):
        if m:
            sigue = inicios[-1][0].select(F.col("src").alias("dst"))
            tramos.append(corte.guardar(tramos[-1].join(sigue, "dst", "left_semi").select("src", "dst"))[0])
        inicios.append(corte.guardar(tramos[-1].select("src").distinct()))
    halladas, faltan = None, k
    for largo in range(maximo, minimo - 1, -1):
        (origenes, n), cuantos = inicios[largo - 1], faltan
        while n:
            caminos, hay_caminos = corte.guardar(_primeros_caminos(tramos[largo - 1::-1], origenes, cuantos))
            mejores, hay = corte.guardar(_con_aristas(caminos, aristas, largo).orderBy("nodos", "canales", "fechas")
                                         .limit(faltan))
            if hay == faltan or hay_caminos < cuantos:
                halladas = mejores if halladas is None else halladas.unionByName(mejores)
                faltan -= hay
                break
            cuantos *= 8
        if not faltan:
            break
    if halladas is None:
        return _con_aristas(e.select(F.array("src", "dst").alias("nodos")).limit(0), aristas, 1)
    return halladas.orderBy(F.desc("chain_length"), "nodos", "canales", "fechas")


def _primeros_caminos(tramos: list[DataFrame], origenes: DataFrame, cuantos: int) -> DataFrame:
    """The first ``cuantos`` ways by user ids that take their first step from the first table, the second from the next."""
    t = origenes.orderBy("src").limit(cuantos).select(F.array("src").alias("nodos"))
    for paso in tramos:
        sig = paso.select(F.col("src").alias("_fin"), F.col("dst").alias("_d"))
        t = (t.withColumn("_fin", F.element_at("nodos", -1)).join(sig, "_fin")
             .select(F.array_append("nodos", F.col("_d")).alias("nodos")).orderBy("nodos").limit(cuantos))
    return t


def _con_aristas(caminos: DataFrame, aristas: DataFrame, largo: int) -> DataFrame:
    """Chains along ways of ``largo`` steps, one for each choice of edges, none of them twice."""
    t = caminos.filter(F.element_at("nodos", 1) != F.element_at("nodos", -1)).select(
        "nodos", F.array().cast("array<string>").alias("canales"), F.array().cast("array<date>").alias("fechas"),
        F.array().cast("array<bigint>").alias("_usadas"))
    for m in range(largo):
        sig = aristas.select(F.col("src").alias("_s"), F.col("dst").alias("_d"), F.col("canal").alias("_c"),
                             F.col("fecha").alias("_f"), F.col("arista").alias("_e"))
        t = (t.withColumn("_s", F.col("nodos")[m]).withColumn("_d", F.col("nodos")[m + 1]).join(sig, ["_s", "_d"])
             .filter(~F.array_contains("_usadas", F.col("_e")))
             .select("nodos", F.array_append("canales", F.col("_c")).alias("canales"),
                     F.array_append("fechas", F.col("_f")).alias("fechas"), F.array_append("_usadas", F.col("_e")).alias("_usadas")))
    return t.select("nodos", "canales", "fechas", F.size("canales").alias("chain_length"))


def cadenas_con_email(cadena: DataFrame, usuarios: DataFrame) -> DataFrame:
    """Replaces the user ids of at most k chains by e-mails: cadena_emails, chain_length, canales, fechas."""
    clave = ["nodos", "canales", "fechas", "chain_length"]
    # equal chains over parallel edges are rows of their own
    una = cadena.withColumn("_u", F.monotonically_increasing_id())
    puestos = (una.select("_u", *clave, F.posexplode("nodos").alias("p", "id")).join(usuarios.select("id", "email"), "id"))
    return (puestos.groupBy("_u", *clave)
            .agg(F.sort_array(F.collect_list(F.struct("p", "email"))).alias("e"))
            .orderBy(F.desc("chain_length"), "nodos", "canales", "fechas")
            .select(F.col("e.email").alias("cadena_emails"), "chain_length", "canales", "fechas"))


# ---- influence -----------------------------------------------------------------------------
# Input is a summary per user (entidad, total, suma_score, productos_comunes, score_min,
# score_max) from similarity.resumen_por_entidad or similarity.resumen_de_aristas.

def _score_promedio() -> Column:
    return F.round(cociente(F.col("suma_score"), F.col("total")), 4)


def mas_influyentes(resumen: DataFrame, usuarios: DataFrame, k: int = 10) -> DataFrame:
    return (resumen.join(usuarios.select(F.col("id").alias("entidad"), "email", "rol"), "entidad")
            .withColumn("score_promedio", _score_promedio())
            .orderBy(F.desc("total"), F.desc("score_promedio"), "entidad").limit(k)
            .select("email", "rol", F.col("total").alias("total_influencias"), "score_promedio",
                    F.col("productos_comunes").alias("productos_comunes_total")))


def mas_influidos(resumen: DataFrame, usuarios: DataFrame, k: int = 10) -> DataFrame:
    return (resumen.join(usuarios.select(F.col("id").alias("entidad"), "email", "rol"), "entidad")
            .withColumn("score_promedio_recibido", _score_promedio())
            .orderBy(F.desc("total"), F.desc("score_promedio_recibido"), "entidad").limit(k)
            .select("email", "rol", F.col("total").alias("veces_influenciado"), "score_promedio_recibido"))


def estadisticas_influencia(salida: DataFrame, entrada: DataFrame) -> DataFrame:
    """One row over the summaries by source and by target user."""
    suma = F.sum(F.col("suma_score").cast("decimal(38,12)"))
    return salida.agg(
        F.coalesce(F.sum("total"), F.lit(0)).cast("bigint").alias("total_influencias"),
        F.count("*").alias("usuarios_influyentes"),
        F.round(F.min("score_min"), 4).alias("score_min"), F.round(F.max("score_max"), 4).alias("score_max"),
        F.round(cociente(suma, F.sum("total")), 4).alias("score_promedio"),
        F.round(cociente(F.sum("productos_comunes"), F.sum("total")), 2).alias("productos_comunes_promedio"),
    ).select("total_influencias", "usuarios_influyentes",
             entrada.agg(F.count("*")).scalar().alias("usuarios_influenciados"), "score_min", "score_max",
             "score_promedio", "productos_comunes_promedio")


def influencia_cruzada(recomienda: DataFrame, influencias: DataFrame, usuarios: DataFrame, k: int = 15,
                       literal: bool = False) -> DataFrame:
    """Users that recommend and users that influence.  ``literal`` gives the counts of two chained
    optional matches, where each edge of one kind is repeated per edge of the other kind."""
    rec = recomienda.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("r"))
    inf = influencias.select(F.col("entidad").alias("id"), F.col("total").alias("i"))
    r, i = F.coalesce("r", F.lit(0)).cast("bigint"), F.coalesce("i", F.lit(0)).cast("bigint")
    uno = F.lit(1).cast("bigint")
    nr, ni = (r * F.greatest(i, uno), i * F.greatest(r, uno)) if literal else (r, i)
    tipo = (F.when((r > 0) & (i > 0), "Ambos").when(r > 0, "Solo Recomienda").when(i > 0, "Solo Influye")
            .otherwise("Ninguno"))
    return (rec.join(inf, "id", "full")
            .select("id", nr.alias("recomendaciones"), ni.alias("influencias"), tipo.alias("tipo_usuario"))
            .join(usuarios.select("id", "email", "rol"), "id")
            .orderBy(F.desc("recomendaciones"), F.desc("influencias"), "id").limit(k)
            .select("email", "rol", "recomendaciones", "influencias", "tipo_usuario"))


def pares_similares(s: Similitud, nombre: str) -> DataFrame:
    """Similar profile pairs with the number of entities behind each side."""
    izq = s.perfiles.selectExpr("perfil AS a", "entidades AS entidades_a")
    der = s.perfiles.selectExpr("perfil AS b", "entidades AS entidades_b")
    return (s.aristas.join(izq, "a").join(der, "b")
            .select("a", "b", "score", F.col("comunes").alias(nombre), "entidades_a", "entidades_b"))


#: Buyers of a product that meet its neighbours in one key.
COMPRADORES_POR_CLAVE = 100_000


class _Vecinos:
    """Neighbour lists of products in blocks of falling counts, and the buyers that read them.

    A block holds the neighbours whose counts lie within a quarter octave, so a list has at most 252 blocks and is put
    in order without being sorted.  ``bloques`` per product: (block, entries, highest count), highest first.  The buyers of
    a product with more than ``por_clave`` of them are as many join keys; its neighbours go to each.
    """

    def __init__(self, compras: DataFrame, detalle: DataFrame, minimo: int, por_clave: int):
        self.corte = Corte(compras.sparkSession, "vecinos")
        cesta, filas = self.corte.guardar(cestas(detalle))
        pares = pares_de_productos(cesta, filas=filas).filter(F.col("veces") >= minimo)
        bloque = F.floor(F.log2("veces") * 4).cast("int")
        # counted from all baskets, so it is worked out once and not for each part that reads it
        lados, _ = self.corte.guardar(pares.select(F.inline(F.array(
            F.struct(F.col("prod1").alias("producto_id"), F.col("prod2").alias("sugerido")),
            F.struct(F.col("prod2").alias("producto_id"), F.col("prod1").alias("sugerido")))), "veces")
            .withColumn("bloque", bloque))
        listas = (lados.groupBy("producto_id", "bloque").agg(F.count("*").alias("n"), F.max("veces").alias("tope"))
                  .groupBy("producto_id")
                  .agg(F.sort_array(F.collect_list(F.struct("bloque", "n", "tope")), asc=False).alias("bloques")))
        productos, _ = self.corte.guardar(
            compras.groupBy("producto_id").agg(F.count("*").alias("n")).join(listas, "producto_id")
            .select("producto_id", "n", F.ceil(F.col("n") / por_clave).cast("int").alias("_partes"), "bloques"))
        total = productos.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        self.lista = lados.join(productos.select("producto_id", "_partes"), "producto_id").select(
            "producto_id", "sugerido", "veces", "bloque", F.explode(F.sequence(F.lit(0), F.col("_partes") - 1)).alias("_s"))
        self.compras, _ = self.corte.guardar(
            unir_por_clave(compras.select("usuario_id", "producto_id"), productos, "producto_id", total).select(
                "usuario_id", "producto_id", "bloques",
                F.pmod(F.xxhash64("usuario_id"), F.col("_partes")).cast("int").alias("_s")))

    def leer(self, bloques: DataFrame) -> DataFrame:
        """Points (usuario_id, sugerido, puntos) from the blocks named in (usuario_id, producto_id, _s, bloque)."""
        return (bloques.join(self.lista, ["producto_id", "_s", "bloque"])
                .groupBy("usuario_id", "sugerido").agg(F.sum("veces").alias("puntos")))

    def consultar(self, candidatos: DataFrame) -> DataFrame:
        """Points of (usuario_id, sugerido) over all products of the user."""
        return (candidatos.join(self.compras.select("usuario_id", "producto_id", "_s"), "usuario_id")
                .join(self.lista.drop("bloque"), ["producto_id", "_s", "sugerido"])
                .groupBy("usuario_id", "sugerido").agg(F.sum("veces").alias("puntos")))


def _primeros(puntos: DataFrame, k: int) -> DataFrame:
    """The k highest per user, ties to the smaller product; Spark's group limit drops the others before the shuffle."""
    orden = W.partitionBy("usuario_id").orderBy(F.desc("puntos"), "sugerido")
    return puntos.withColumn("puesto", F.row_number().over(orden)).filter(F.col("puesto") <= k)


def _umbral(puntos: DataFrame, k: int) -> DataFrame:
    """Points that k products of a user reach: (usuario_id, umbral); users with fewer products are not in it."""
    return (_primeros(puntos, k).filter(F.col("puesto") == k).select("usuario_id", F.col("puntos").alias("umbral")))


def _plan(v: _Vecinos, nuevos: Callable[[DataFrame], DataFrame], k: int) -> DataFrame:
    """Per user and product the blocks to read (``leidos``), the highest count behind them (``resto``) and the points that
    k products of the user reach (``umbral``, null where there are fewer: then every block is read)."""
    # entries in the blocks before each: a head ends with the block that reaches k
    antes = F.expr("transform(bloques, (x, i) -> struct(x.bloque AS bloque, "
                   "aggregate(slice(bloques, 1, i), 0L, (s, y) -> s + y.n) AS antes))")
    cabezas = (v.compras.select("usuario_id", "producto_id", "_s", F.inline(antes)).filter(F.col("antes") < k).drop("antes"))
    listas = (v.compras.groupBy("usuario_id").agg(F.count("*").alias("listas"))
              .join(_umbral(nuevos(v.leer(cabezas)), k), "usuario_id", "left"))
    return v.compras.join(listas, "usuario_id").select(
        "usuario_id", "producto_id", "_s", "umbral",
        F.expr("filter(bloques, x -> x.tope * listas >= coalesce(umbral, 0))").alias("leidos"),
        F.expr("coalesce(array_max(transform(filter(bloques, x -> x.tope * listas < umbral), x -> x.tope)), 0L)").alias("resto"))


def recomendar_productos(compras: DataFrame, detalle: DataFrame, minimo: int = 2, k: int = 5,
                         por_clave: int = COMPRADORES_POR_CLAVE) -> DataFrame:
    """Per user, the k products most often bought together with products the user has bought
    and that the user has not bought.  ``compras(usuario_id, producto_id)`` is distinct; only
    products bought together at least ``minimo`` times recommend each other.

    Three rounds of a threshold search (Cao and Wang, PODC 2004) read only the part of the neighbour lists that can matter.
    The first reads the head of each list, k entries or more, and gives points that k products reach.  The second reads
    every block whose highest count is at least that threshold divided by the user's lists: a product in none of them is
    below the threshold, ties included.  What the unread rest of the lists can add bounds the products seen, and the third
    looks up the exact points of those that can still be among the k.  Users whose lists are read to their ends need no third.

    A product with more than ``por_clave`` buyers is as many join keys: its buyers are dealt out by user, its neighbours
    (at most all products) go to each key.
    """
    # read at five places below
    compras, _ = Corte(compras.sparkSession, "compras").guardar(compras.select("usuario_id", "producto_id"))
    v = _Vecinos(compras, detalle, minimo, por_clave)
    propios = compras.select("usuario_id", F.col("producto_id").alias("sugerido"))
    nuevos = lambda p: p.join(propios, ["usuario_id", "sugerido"], "left_anti")

    planes, _ = v.corte.guardar(_plan(v, nuevos, k))
    cota = planes.groupBy("usuario_id").agg(F.sum("resto").alias("cota"), F.max("umbral").alias("umbral"))
    vistos, _ = v.corte.guardar(nuevos(v.leer(planes.select(
        "usuario_id", "producto_id", "_s", F.explode("leidos.bloque").alias("bloque")))).join(cota, "usuario_id"))

    abiertos = vistos.filter("cota > 0")
    mejor = _umbral(abiertos, k).withColumnRenamed("umbral", "umbral2")
    posibles = (abiertos.join(mejor, "usuario_id").filter("puntos + cota >= greatest(umbral, umbral2)")
                .select("usuario_id", "sugerido"))
    exactos = vistos.filter("cota = 0").drop("cota", "umbral").unionByName(v.consultar(posibles))
    return _primeros(exactos, k).select("usuario_id", "puesto", F.col("sugerido").alias("producto_id"), "puntos")
