"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.functions import geo
from comanda.operators import comunidades, copurchase, cubes, dashboards as tab, dispatch, grafo, paths, quality, rank
from comanda.operators import similarity, social, spatial, star
from comanda.operators import summaries as resumenes
from comanda.plans import vueltas
from comanda.plans.durable import Corte
from comanda.sources import sinks
from comanda.sources.derivadas import Dominio

UMBRAL_USUARIOS = 0.05
UMBRAL_PRODUCTOS = 0.04

Consulta = Callable[[SparkSession, str], DataFrame]


class Almacen:
    """Star and dashboard schemas over one folder of test tables, each built when first used."""

    def __init__(self, d: Dominio):
        self.d = d

    hechos = cached_property(lambda a: star.hechos_reservas(a.d.reservas, a.d.pedidos_cabecera))
    usuario = cached_property(lambda a: star.dim_usuario(a.d.usuarios))
    restaurante = cached_property(lambda a: star.dim_restaurante(a.d.restaurantes))
    hechos_cabecera = cached_property(
        lambda a: star.hechos_reservas(a.d.reservas_cabecera, a.d.pedidos_cabecera))
    menu = cached_property(lambda a: star.dim_menu(a.d.menus))
    fp = cached_property(lambda a: tab.fact_pedidos(a.d.pedidos))
    fp_cabecera = cached_property(lambda a: tab.fact_pedidos_cabecera(a.d.pedidos_cabecera))
    fr = cached_property(lambda a: tab.fact_reservas(a.d.reservas_cabecera))
    detalle = cached_property(
        lambda a: grafo.incluye_detalle(a.d.pedido_detalle, a.d.pedidos_cabecera, a.d.menus))
    realizo = cached_property(lambda a: grafo.realizo(a.d.usuarios, a.d.pedidos_cabecera))
    en_restaurante = cached_property(lambda a: grafo.en_restaurante(a.d.pedidos, a.d.restaurantes))
    incluye = cached_property(lambda a: grafo.incluye(a.d.pedidos, a.d.menus))
    reservo = cached_property(lambda a: grafo.reservo(a.d.reservas, a.d.usuarios, a.d.restaurantes))
    compras = cached_property(lambda a: a.d.pedidos_cabecera.select(F.col("id").alias("src"), "usuario_id")
                              .join(a.detalle, "src").select("usuario_id", F.col("dst").alias("producto_id"))
                              .distinct())
    similares = cached_property(lambda a: similarity.similitud(
        a.compras.toDF("entidad", "item"), UMBRAL_USUARIOS))
    influencia = cached_property(lambda a: similarity.resumen_por_entidad(a.similares))
    ancla = cached_property(lambda a: spatial.anclar_restaurantes(a.d.restaurantes, a.d.calle))
    # road node of the restaurant and of the customer of every order
    pares_pedido = cached_property(lambda a: a.d.pedidos.select(
        F.col("restaurante_id").alias("src"), F.col("usuario_id").alias("destino"))
        .join(a.ancla.select("src", F.col("dst").alias("origen")), "src")
        .join(a.d.calle.select(F.col("id").alias("destino")), "destino").select("origen", "destino").distinct())
    ruta_pedido = cached_property(lambda a: paths.ruta_mas_corta(a.pares_pedido, a.d.road, nodos=a.d.calle))
    # path details go as far as the paths they describe
    ruta_larga = cached_property(lambda a: paths.ruta_por_tramos(a.pares_pedido, a.d.road, 100, a.d.calle))
    anclas_restaurante = cached_property(lambda a: a.d.restaurantes.join(
        a.ancla.select(F.col("src").alias("id"), F.col("dst").alias("osm_node_id")), "id")
        .select("id", "nombre", "osm_node_id"))
    alcances = cached_property(lambda a: paths.alcances(
        a.anclas_restaurante, a.anclas_cliente, a.d.road, nodos=a.d.calle))
    # orders to deliver come from all order lines: what assignment, tours and reports read of them is made once
    pedidos_entrega = cached_property(lambda a: Corte(a.d.spark, "pedidos_entrega").guardar(a.d.pedidos_entrega.select(
        "id", "cliente_id", "zona", "estado", "prioridad", "fecha_creacion"), contar=False)[0])
    # orders are assigned once, whatever reads the assignment
    asignacion = cached_property(lambda a: Corte(a.d.spark, "asignacion").guardar(dispatch.asignar(
        a.pedidos_entrega, a.d.repartidores, a.d.clientes))[0])
    asignados = cached_property(lambda a: dispatch.aplicar_asignacion(a.pedidos_entrega, a.asignacion))
    tramos = cached_property(lambda a: dispatch.tramos_y_resto(
        a.asignacion, a.d.repartidores,
        a.pedidos_entrega.select(F.col("id").alias("pedido_id"), F.col("cliente_id").alias("id"))
        .join(a.asignacion.select("pedido_id"), "pedido_id", "left_semi")
        .join(a.d.clientes.select("id", "lat", "lon"), "id").drop("id"), a.d.calle, a.d.road))
    # restaurants and customers with their road node, customers at the node of their own id
    anclas_cliente = cached_property(lambda a: a.d.clientes.select(
        "id", F.col("email").alias("nombre"), "lat", "lon", F.col("id").alias("osm_node_id")))
    t_usuario = cached_property(lambda a: tab.dim_usuario(a.d.usuarios))
    t_menu = cached_property(lambda a: tab.dim_menu(a.d.menus))
    t_restaurante = cached_property(lambda a: tab.dim_restaurante(a.d.restaurantes))


def _cubos() -> dict[str, Callable[[Almacen], DataFrame]]:
    return {
        "e01_dim_tiempo": lambda a: star.dim_tiempo(a.d.reservas_cabecera),
        "e02_dim_usuario": lambda a: a.usuario,
        "e03_dim_restaurante": lambda a: a.restaurante,
        "e04_dim_menu": lambda a: a.menu,
        "e05_hechos_reservas": lambda a: a.hechos,
        "a01_ingresos_mes_categoria": lambda a: cubes.ingresos_mes_categoria(a.hechos, a.menu),
        "a02_actividad_geo": lambda a: cubes.actividad_geo(a.hechos, a.restaurante),
        "a03_estado_pedido_mes": lambda a: cubes.estado_pedido_mes(a.hechos_cabecera),
        "a04_frecuencia_menu": lambda a: cubes.frecuencia_menu(a.hechos, a.menu),
        "a05_usuarios_ingresos": lambda a: cubes.usuarios_ingresos(a.hechos_cabecera, a.usuario),
        "a06_tendencias_consumo": lambda a: cubes.tendencias_consumo(a.hechos, a.menu),
        "a07_horarios_pico_detalle": lambda a: cubes.horarios_pico_detalle(a.hechos_cabecera),
        "a08_horarios_pico": lambda a: cubes.horarios_pico(a.hechos_cabecera),
        "a09_crecimiento_mensual_detalle": lambda a: cubes.crecimiento_mensual_detalle(a.hechos_cabecera),
        "a10_crecimiento_mensual": lambda a: cubes.crecimiento_mensual(a.hechos_cabecera),
        "a11_ingresos_categoria_mes": lambda a: tab.ingresos_categoria_mes(a.fp, a.t_menu),
        "a12_tendencia_ingresos_categoria": lambda a: tab.tendencia_ingresos_categoria(a.fp, a.t_menu),
        "a13_top_productos_ingresos": lambda a: tab.top_productos_ingresos(a.fp, a.t_menu, a.t_restaurante),
        "a14_actividad_zona_geografica": lambda a: tab.actividad_zona_geografica(a.t_usuario, a.fp_cabecera, a.fr),
        "a14_actividad_zona_geografica_fixed":
            lambda a: tab.actividad_zona_geografica(a.t_usuario, a.fp_cabecera, a.fr, corregida=True),
        "a15_actividad_zona_temporal": lambda a: tab.actividad_zona_temporal(a.t_usuario, a.fp_cabecera),
        "a16_demografia_zona": lambda a: tab.demografia_zona(a.t_usuario, a.fp_cabecera),
        "a17_estadisticas_pedidos": lambda a: tab.estadisticas_pedidos(a.fp_cabecera),
        "a18_pedidos_estado_temporal": lambda a: tab.pedidos_estado_temporal(a.fp_cabecera),
        "a19_pedidos_por_restaurante": lambda a: tab.pedidos_por_restaurante(a.fp, a.t_restaurante),
        "a20_cancelaciones_categoria": lambda a: tab.cancelaciones_categoria(a.fp, a.t_menu),
        "a21_rendimiento_horario": lambda a: tab.rendimiento_horario(a.fp_cabecera),
    }


def _lista(c: str) -> Column:
    """(canal, cantidad) pairs as text, for result comparison across engines."""
    return F.array_join(F.transform(c, lambda x: F.concat(x["canal"], F.lit(":"), x["cantidad"].cast("string"))), ",")


def _distancias_pedido(a: Almacen) -> DataFrame:
    """Straight distances restaurant - customer of every order."""
    d = a.d
    r = d.restaurantes.select(F.col("id").alias("restaurante_id"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"))
    c = d.clientes.select(F.col("id").alias("usuario_id"), "lat", "lon")
    p = [F.col(x) for x in ("rlat", "rlon", "lat", "lon")]
    metros = geo.haversine_m(*p)
    return d.pedidos.join(r, "restaurante_id").join(c, "usuario_id").select(
        "id", F.round(metros, 3).alias("haversine_m"), F.round(geo.plana_m(*p), 3).alias("plana_m"),
        F.round(geo.manhattan_grados(*p), 6).alias("manhattan_grados"),
        geo.minutos_viaje(metros).alias("minutos"))


def _costo_desde_restaurante(a: Almacen) -> DataFrame:
    """What every order would cost the courier that waits at its restaurant."""
    r = a.d.repartidores.select(F.col("id").alias("restaurante_id"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"),
                                "velocidad_promedio", "carga")
    c = a.d.clientes.select(F.col("id").alias("cliente_id"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    metros = geo.haversine_m(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    return (a.d.pedidos_entrega.join(r, "restaurante_id").join(c, "cliente_id")
            .select("id", geo.costo_repartidor(metros, F.col("velocidad_promedio"), F.col("carga")).alias("costo")))


def _estado_con_rutas(a: Almacen) -> DataFrame:
    """System state once pending orders are assigned, tours are made and deliveries are reported."""
    pedidos, _ = Corte(a.d.spark, "estado").guardar(dispatch.completar_entregas(a.asignados, _entregas(a)).select("id", "estado"))
    return resumenes.estado_sistema(a.d.clientes, a.d.repartidores, pedidos, dispatch.rutas_activas(a.tramos[0], pedidos))


def _grafo() -> dict[str, Callable[[Almacen], DataFrame]]:
    return {
        "a22_resumen": lambda a: resumenes.resumen(
            a.d.restaurantes, a.d.usuarios, a.d.menus, a.d.pedidos_cabecera, a.d.pedido_detalle),
        "a23_resumen_por_cocina": lambda a: resumenes.resumen_por_cocina(a.d.restaurantes, a.d.menus, a.d.pedidos),
        "a24_conteo_hechos": lambda a: a.hechos_cabecera.agg(F.count("*").alias("total")),
        "a25_estadisticas_cesta": lambda a: resumenes.estadisticas_cesta(a.detalle, a.d.pedidos_cabecera),
        "a26_estado_sistema": lambda a: resumenes.estado_sistema(
            a.d.clientes, a.d.repartidores, a.d.pedidos_entrega,
            a.d.repartidores.filter("carga > 0").select(F.col("id").alias("repartidor_id"))),
        "a26_estado_con_rutas": _estado_con_rutas,
        "a27_estadisticas_carga": lambda a: resumenes.estadisticas_carga(
            usuarios=a.d.usuarios, restaurantes=a.d.restaurantes, pedidos=a.d.pedidos_cabecera,
            clientes=a.d.clientes, repartidores=a.d.repartidores, calles=a.d.calle),
        "a28_mejores_clientes": lambda a: resumenes.mejores_clientes(a.d.usuarios, a.d.pedidos_cabecera),
        "x12_distancias_pedido": _distancias_pedido,
        "x16_costo_desde_restaurante": _costo_desde_restaurante,
        "q02_huerfanos": lambda a: quality.huerfanos(a.d.pedidos_cabecera, a.d.reservas_cabecera),
        "q06_informe": lambda a: quality.informe(
            {"dim_usuario": a.usuario, "dim_restaurante": a.restaurante, "dim_menu": a.menu,
             "dim_tiempo": star.dim_tiempo(a.d.reservas_cabecera), "hechos_reservas": a.hechos},
            {"usuarios": a.d.usuarios, "restaurantes": a.d.restaurantes, "menus": a.d.menus,
             "reservas": a.d.reservas_cabecera, "pedidos": a.d.pedidos_cabecera}),
        "k06_documentos_busqueda": lambda a: sinks.documentos_busqueda(a.d.menus, F.lit("2024-01-31T02:00:00")),
        "q07_reservas_completas": lambda a: star.reservas_completas(
            a.d.reservas, a.d.pedidos_cabecera, F.add_months(F.lit("2001-01-31").cast("date"), -12)),
        "q08_menus_activos": lambda a: star.menus_activos(a.d.menus, a.d.restaurantes),
        "j12_realizo": lambda a: a.realizo,
        "j12_en_restaurante": lambda a: a.en_restaurante,
        "j12_incluye": lambda a: a.incluye,
        "j13_incluye_detalle": lambda a: a.detalle,
        "j13_reservo": lambda a: a.reservo,
        "j11_nombres_de_calle": lambda a: grafo.actualizar_nombres(
            a.d.calle, a.d.road.selectExpr("src AS node_id", "nombre AS street_name").filter("nombre <> ''")),
        "j17_anclas_con_nodo": lambda a: grafo.anclas_con_nodo(a.anclas_cliente, a.d.calle),
        "g01_nodos_por_tipo": lambda a: grafo.conteo_por_tipo(
            "tipo_nodo", Usuario=a.d.usuarios, Restaurante=a.d.restaurantes, Producto=a.d.menus,
            Pedido=a.d.pedidos_cabecera, Calle=a.d.calle),
        "g02_relaciones_por_tipo": lambda a: grafo.conteo_por_tipo(
            "tipo_relacion", REALIZO=a.realizo, EN_RESTAURANTE=a.en_restaurante, INCLUYE=a.incluye,
            INCLUYE_DETALLE=a.detalle, RESERVO=a.reservo, RECOMIENDA=a.d.recomienda,
            ROAD=grafo.simetrica(a.d.road)),
        "g03_estadisticas_grafo": lambda a: grafo.estadisticas_grafo(
            a.d.usuarios, a.d.restaurantes, a.d.menus, a.d.pedidos_cabecera, a.d.calle,
            [a.realizo, a.en_restaurante, a.incluye, a.detalle, a.reservo]),
        "g04_estadisticas_vial": lambda a: grafo.estadisticas_vial(
            a.d.calle, a.d.road, a.d.restaurantes, a.d.clientes),
        "g05_caminos_de_vias": lambda a: grafo.caminos_de_vias(_vias(a), a.d.calle),
        "g08_cruces_principales": lambda a: grafo.cruces_principales(a.d.calle, a.d.road),
        "g09_conectados_aislados": lambda a: grafo.conectados_aislados(a.d.calle, a.d.road),
        "g10_conectividad_restaurantes": lambda a: grafo.conectividad_anclas(
            a.anclas_restaurante, a.d.calle, a.d.road),
        "g10_conectividad_clientes": lambda a: grafo.conectividad_anclas(
            a.anclas_cliente, a.d.calle, a.d.road),
        "g11_calles_frecuentes": lambda a: grafo.calles_frecuentes(a.d.road),
        "g11_calles_distintas": lambda a: grafo.calles_distintas(a.d.road),
        "g11_estadisticas_nombres": lambda a: grafo.estadisticas_nombres(a.d.road),
        "g12_co_compras": lambda a: copurchase.co_compras(a.detalle, a.d.menus),
        "g13_co_compras_categoria": lambda a: copurchase.co_compras_categoria(a.detalle, a.d.menus),
        "g13_co_compras_categoria_sin_minimo": lambda a: copurchase.co_compras_categoria(a.detalle, a.d.menus, 10, 1),
        "g14_co_compras_valor": lambda a: copurchase.co_compras_valor(a.detalle, a.d.menus),
        "g15_co_compras_mismo_restaurante": lambda a: copurchase.co_compras_mismo_restaurante(a.detalle, a.d.menus),
        "g16_usuarios_influyentes": lambda a: rank.usuarios_influyentes(a.d.usuarios, a.realizo),
        "g17_actividad_usuarios": lambda a: grafo.actividad_usuarios(a.d.usuarios, a.realizo),
        "g18_influye_en": lambda a: social.pares_similares(a.similares, "productos_comunes"),
        "g19_restaurantes_populares": lambda a: grafo.restaurantes_populares(a.d.restaurantes, a.en_restaurante),
        "g19_restaurantes_populares_gourmet": lambda a: grafo.restaurantes_populares(
            a.d.restaurantes, a.en_restaurante, "gourmet"),
        "g20_mas_recomiendan": lambda a: social.ranking_recomendaciones(a.d.recomienda, a.d.usuarios).select(
            "email", "rol", F.col("total").alias("total_recomendaciones"), _lista("canales").alias("canales_usados")),
        "g20_mas_recomendados": lambda a: social.ranking_recomendaciones(a.d.recomienda, a.d.usuarios, "dst").select(
            "email", "rol", F.col("total").alias("veces_recomendado"), _lista("canales").alias("canales_recibidos")),
        "g21_estadisticas_recomendacion": lambda a: social.estadisticas_recomendacion(a.d.recomienda).withColumn(
            "distribucion_canales", _lista("distribucion_canales")),
        "g22_mas_influyentes": lambda a: social.mas_influyentes(a.influencia, a.d.usuarios),
        "g23_mas_influidos": lambda a: social.mas_influidos(a.influencia, a.d.usuarios),
        "g24_estadisticas_influencia": lambda a: social.estadisticas_influencia(a.influencia, a.influencia),
        "g25_cadenas": lambda a: social.cadenas_con_email(social.cadenas(a.d.recomienda), a.d.usuarios).select(
            F.array_join("cadena_emails", ">").alias("cadena"), "chain_length",
            F.array_join("canales", ">").alias("canales"),
            F.array_join(F.col("fechas").cast("array<string>"), ">").alias("fechas")),
        "g26_cadenas_de_dos": lambda a: social.cadenas_con_email(
            social.cadenas(a.d.recomienda, 2, 2), a.d.usuarios).select(
            F.col("cadena_emails")[0].alias("inicio"), F.col("cadena_emails")[1].alias("intermedio"),
            F.col("cadena_emails")[2].alias("fin")),
        "g27_mutuas": lambda a: social.mutuas(a.d.recomienda),
        "g27_mutuas_con_email": lambda a: social.mutuas_con_email(social.mutuas(a.d.recomienda), a.d.usuarios),
        "g28_influencia_cruzada": lambda a: social.influencia_cruzada(a.d.recomienda, a.influencia, a.d.usuarios),
        "g28_influencia_cruzada_literal": lambda a: social.influencia_cruzada(
            a.d.recomienda, a.influencia, a.d.usuarios, literal=True),
        "g29_comunidades": lambda a: rank.componentes(a.d.usuarios, a.d.recomienda),
        "g29_comunidades_modularidad": lambda a: comunidades.comunidades(a.d.usuarios, a.d.recomienda),
        "g29_calidad_por_ciudad": lambda a: comunidades.calidad(
            a.d.usuarios.select("id", F.col("ciudad").alias("comunidad")), a.d.recomienda),
        "g30_productos_similares": lambda a: social.pares_similares(similarity.similitud(
            a.detalle.select(F.col("dst").alias("entidad"), F.col("src").alias("item")).distinct(),
            UMBRAL_PRODUCTOS), "pedidos_comunes"),
        "g31_recomendar_productos": lambda a: social.recomendar_productos(a.compras, a.detalle),
    }


def _rutas() -> dict[str, Callable[[Almacen], DataFrame]]:
    return {
        "g07_alcance": lambda a: paths.alcance(a.d.calle, a.d.road),
        "r02_anclar_restaurantes": lambda a: a.ancla,
        "r03_calle_mas_cercana": lambda a: spatial.calle_mas_cercana(
            a.d.clientes.select("id", "lat", "lon"), a.d.calle).select("id", "calle_id", "distancia"),
        "r04_registrar_clientes": lambda a: spatial.registrar_clientes(a.d.clientes, a.d.calle, 2.0)[0].select(
            "id", "calle_id", "distancia"),
        "r04_clientes_rechazados": lambda a: spatial.registrar_clientes(a.d.clientes, a.d.calle, 2.0)[1],
        "r05_ruta_mas_corta": lambda a: a.ruta_pedido.select(
            "origen", "destino", "num_calles", "distancia", F.size("calles").alias("nodos")),
        "r06_ruta_hasta_100": lambda a: a.ruta_larga.select(
            "origen", "destino", F.col("num_calles").alias("segmentos")),
        "r07_ruta_menor_distancia": lambda a: paths.ruta_menor_distancia(a.pares_pedido, a.d.road).select(
            "origen", "destino", "distancia"),
        "r08_tramos": lambda a: dispatch.tramos_completos(a.tramos[0], a.tramos[2]),
        "r09_asignacion": lambda a: a.asignacion,
        "r10_rutas": lambda a: _sin_ruta(dispatch.con_resto(dispatch.rutas(a.tramos[0]), a.tramos[2])).withColumn(
            "pedidos", F.array_join(F.col("pedidos").cast("array<string>"), ",")),
        "r10_tiempos_estimados": lambda a: dispatch.tramos_completos(
            dispatch.tiempos_estimados(dispatch.rutas(a.tramos[0])), a.tramos[2]),
        "r10_trazado": lambda a: _sin_ruta(dispatch.con_resto(dispatch.trazado(*a.tramos[:2]), a.tramos[2])).withColumn(
            "calles_ruta", F.array_join(F.col("calles_ruta").cast("array<string>"), ",")),
        "r11_progreso": lambda a: dispatch.progreso_completo(
            dispatch.rutas(a.tramos[0]), a.tramos[2], dispatch.completar_entregas(a.pedidos_entrega, _entregas(a))),
        "r12_carga_tras_entregas": lambda a: dispatch.carga_actual(
            a.d.repartidores, dispatch.completar_entregas(
                a.d.pedidos_entrega.withColumn("repartidor_asignado", F.col("restaurante_id")), _entregas(a)))
        .select("id", "carga"),
        "r12_entregas_de_asignados": lambda a: dispatch.carga_actual(
            a.d.repartidores, dispatch.completar_entregas(a.asignados, _entregas(a))).select("id", "carga"),
        "r13_ultima_posicion": lambda a: spatial.ultima_posicion(a.d.repartidores, a.d.posiciones).select("id", "lat", "lon"),
        "r14_registrar_repartidores": lambda a: spatial.registrar_repartidores(
            a.d.repartidores, a.d.calle, 1000.0).select("id", "calle_actual"),
        "r15_matriz_conectividad": lambda a: paths.matriz_conectividad(
            a.anclas_restaurante, a.anclas_cliente, a.d.road, nodos=a.d.calle),
        "r16_rutas_cortas": lambda a: paths.rutas_extremas(a.alcances, a.anclas_restaurante, a.anclas_cliente),
        "r16_rutas_largas": lambda a: paths.rutas_extremas(
            a.alcances, a.anclas_restaurante, a.anclas_cliente, largas=True),
        "r17_segmentos_por_restaurante": lambda a: paths.segmentos_por_restaurante(
            a.alcances, a.anclas_restaurante),
        "r18_restaurante_centrico": lambda a: paths.promedio_segmentos(
            a.alcances, a.anclas_restaurante, "restaurante"),
        "r18_cliente_accesible": lambda a: paths.promedio_segmentos(a.alcances, a.anclas_cliente, "cliente"),
        "r19_prueba_conectividad": lambda a: paths.prueba_conectividad(
            a.alcances, a.anclas_restaurante, a.anclas_cliente),
        "r20_primeros_pasos": lambda a: paths.pasos_de_ruta(
            a.ruta_larga, ["origen", "destino"], a.d.calle, a.d.road),
        "r20_detalle_de_ruta": lambda a: paths.detalle_de_ruta(
            a.ruta_larga, ["origen", "destino"], a.d.calle, a.d.road).withColumns({
                "nodos": _texto("nodos", "osm_id", "lat", "lon"), "calles": _texto("calles", "nombre", "distancia")}),
        "r05_coordenadas": lambda a: paths.con_coordenadas(a.ruta_pedido, a.d.calle, ["origen", "destino"]).withColumns({
            "calles": F.array_join(F.col("calles").cast("array<string>"), ","),
            "coordenadas": _texto("coordenadas", "lat", "lon")}),
        "r22_resumen_de_ruta": lambda a: paths.resumen_de_ruta(a.ruta_larga, a.d.calle, ["origen", "destino"]),
    }


def _texto(lista: str, *campos: str) -> Column:
    """A list of structs as text, for result comparison across engines; a missing name is a dash."""
    return F.array_join(F.transform(lista, lambda x: F.concat_ws(
        " ", *[F.coalesce(x[c].cast("string"), F.lit("-")) for c in campos])), ",")


def _sin_ruta(df: DataFrame) -> DataFrame:
    """Orders without a leg as text, for result comparison across engines."""
    return df.withColumn("pedidos_sin_ruta", F.array_join(F.transform(
        "pedidos_sin_ruta", lambda x: F.concat(x["pedido_id"].cast("string"), F.lit(":"), x["motivo"])), ","))


def _entregas(a: Almacen) -> DataFrame:
    """Delivery reports: the order of every purchase event."""
    return a.d.tabla("events").filter("event_type = 'purchase'").select(F.col("event_id").alias("pedido_id"))


def _vias(a: Almacen) -> DataFrame:
    """Ways: each row of the road grid in column order (at most 40 nodes per way)."""
    return (a.d.calle.groupBy(F.floor(F.col("id") / 40).alias("id"))
            .agg(F.sort_array(F.collect_list(F.col("id"))).alias("nd")))


def consultas() -> dict[str, Consulta]:
    def sobre_almacen(f: Callable[[Almacen], DataFrame]) -> Consulta:
        return lambda spark, carpeta: f(Almacen(Dominio(spark, carpeta)))

    ida_y_vuelta = {k: (lambda a, f=f: f(a.d)) for k, f in vueltas.consultas().items()}
    return {k: sobre_almacen(f) for k, f in {**_cubos(), **_grafo(), **_rutas(), **ida_y_vuelta}.items()}
