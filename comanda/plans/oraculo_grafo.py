"""Oracle SQL of the summaries, the quality checks and the graph operators."""

from comanda.plans.oraculo import AV, B, D, registrar


def _cuenta(t: str) -> str:
    return f"(SELECT COUNT(*) FROM {t})"


def _por_tipo(columna: str, pares: dict[str, str]) -> str:
    partes = " UNION ALL ".join(f"SELECT '{n}' AS {columna}, COUNT(*) AS cantidad FROM ({q})" for n, q in pares.items())
    return f"SELECT * FROM ({partes}) WHERE cantidad > 0"


REALIZO = "SELECT o_custkey AS src, o_orderkey AS dst FROM orders JOIN customer ON c_custkey = o_custkey"
EN_REST = "SELECT p.id AS src, p.restaurante_id AS dst FROM pedidos p JOIN restaurantes r ON r.id = p.restaurante_id"
INCLUYE = "SELECT p.id AS src, p.menu_id AS dst FROM pedidos p JOIN menus m ON m.id = p.menu_id"
RESERVO = """SELECT s.usuario_id AS src, s.restaurante_id AS dst, CAST(s.timestamp_reserva AS DATE) AS fecha,
    strftime(s.timestamp_reserva, '%H:%M:%S') AS hora, s.invitados, s.estado
    FROM reservas s JOIN usuarios u ON u.id = s.usuario_id JOIN restaurantes r ON r.id = s.restaurante_id"""
CANALES = "string_agg(canal || ':' || n, ',' ORDER BY canal)"


def _ranking(lado: str, total: str, canales: str) -> str:
    return f"""SELECT u.email, u.rol, CAST(SUM(n) AS BIGINT) AS {total}, {CANALES} AS {canales}
        FROM (SELECT {lado} AS id, canal, COUNT(*) AS n FROM recomienda GROUP BY 1, 2) r JOIN usuarios u ON u.id = r.id
        GROUP BY u.id, u.email, u.rol ORDER BY 3 DESC, u.id LIMIT 10"""


def _similares(conjuntos: str, umbral: float, nombre: str) -> str:
    return f"""SELECT a, b, score, {nombre}, CAST(1 AS BIGINT) AS entidades_a, CAST(1 AS BIGINT) AS entidades_b FROM (
        SELECT e.a, e.b, CAST(e.n AS DOUBLE) / (x.n + y.n - e.n) AS score, e.n AS {nombre} FROM
          (SELECT s.entidad AS a, t.entidad AS b, COUNT(*) AS n FROM ({conjuntos}) s JOIN ({conjuntos}) t
             ON s.item = t.item AND s.entidad < t.entidad GROUP BY 1, 2) e
          JOIN (SELECT entidad, COUNT(*) AS n FROM ({conjuntos}) GROUP BY 1) x ON x.entidad = e.a
          JOIN (SELECT entidad, COUNT(*) AS n FROM ({conjuntos}) GROUP BY 1) y ON y.entidad = e.b) WHERE score >= {umbral}"""


SCORE = "CAST(SUM(CAST(score AS DECIMAL(20,12))) AS DOUBLE)"
CRUCE = """SELECT u.id, u.email, u.rol, COALESCE(r.n, 0) AS r, COALESCE(i.n, 0) AS i FROM usuarios u
    LEFT JOIN (SELECT src, COUNT(*) AS n FROM recomienda GROUP BY 1) r ON r.src = u.id
    LEFT JOIN (SELECT src, COUNT(*) AS n FROM influye GROUP BY 1) i ON i.src = u.id"""
TIPO = "list_extract(['Ninguno', 'Solo Recomienda', 'Solo Influye', 'Ambos'], 1 + CAST(r > 0 AS INT) + 2 * CAST(i > 0 AS INT))"
GRADOS = "SELECT id, COUNT(*) AS n FROM (SELECT src AS id FROM {t} UNION ALL SELECT dst FROM {t}) GROUP BY 1"

registrar(
    a22_resumen=f"""SELECT {_cuenta('restaurantes')} AS restaurantes, {_cuenta('usuarios')} AS usuarios,
        {_cuenta('menus')} AS productos, COUNT(*) AS pedidos, COUNT(*) FILTER (estado = 'completado') AS pedidos_completados,
        COUNT(*) FILTER (estado = 'cancelado') AS pedidos_cancelados,
        {D("CASE WHEN estado = 'completado' THEN total END")} AS ingresos_total,
        {AV("CASE WHEN estado = 'completado' THEN total END")} AS ticket_promedio,
        MIN(CAST(fecha_creacion AS DATE)) AS fecha_inicio, MAX(CAST(fecha_creacion AS DATE)) AS fecha_fin,
        CAST(date_diff('day', MIN(CAST(fecha_creacion AS DATE)), MAX(CAST(fecha_creacion AS DATE))) AS INT) AS dias_total,
        {_cuenta('pedido_detalle')} AS detalles_pedido FROM pedidos""",
    a23_resumen_por_cocina=f"""SELECT r.categoria_local, COUNT(*) AS restaurantes,
        CAST(SUM((SELECT COUNT(*) FROM menus m WHERE m.restaurante_id = r.id)) AS BIGINT) AS productos,
        CAST(SUM((SELECT COUNT(*) FROM pedidos p WHERE p.restaurante_id = r.id AND p.estado = 'completado')) AS BIGINT) AS pedidos,
        CAST(SUM((SELECT COALESCE(SUM(CAST(p.total AS DECIMAL(18,2))), 0) FROM pedidos p
                  WHERE p.restaurante_id = r.id AND p.estado = 'completado')) AS DOUBLE) AS ingresos_total
        FROM restaurantes r GROUP BY 1""",
    a24_conteo_hechos="SELECT COUNT(*) AS total FROM hechos_reservas",
    a25_estadisticas_cesta=f"""SELECT COUNT(*) AS total_detalle, COUNT(DISTINCT src) AS pedidos_con_detalle,
        {_cuenta('pedidos')} AS total_pedidos,
        ROUND(CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT src), 2) AS promedio_productos_por_pedido FROM incluye_detalle""",
    a26_estado_sistema=f"""SELECT {_cuenta('clientes')} AS clientes_registrados,
        {_cuenta('repartidores WHERE activo')} AS repartidores_activos,
        {_cuenta("pedidos_entrega WHERE estado = 'pendiente'")} AS pedidos_pendientes,
        {_cuenta("pedidos_entrega WHERE estado = 'en_ruta'")} AS pedidos_en_ruta,
        {_cuenta('repartidores WHERE carga > 0')} AS rutas_activas""",
    a27_estadisticas_carga=_por_tipo("entidad", {t: f"SELECT * FROM {s}" for t, s in {
        "usuarios": "usuarios", "restaurantes": "restaurantes", "pedidos": "pedidos", "clientes": "clientes",
        "repartidores": "repartidores", "calles": "calle"}.items()}),
    a28_mejores_clientes=f"""SELECT u.email, COUNT(*) AS total_pedidos, {D('p.total')} AS gasto_total
        FROM pedidos p JOIN usuarios u ON u.id = p.usuario_id GROUP BY 1 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 10""",
    x12_distancias_pedido="""SELECT id, ROUND(h, 3) AS haversine_m, ROUND(p, 3) AS plana_m, ROUND(m, 6) AS manhattan_grados,
        CAST(CASE WHEN h <= 0 THEN 0 ELSE GREATEST(1, FLOOR(h / 1000 / 25.0::DOUBLE * 60)) END AS INT) AS minutos FROM (
        SELECT p.id, 2 * 6371000.0::DOUBLE * asin(sqrt(pow(sin(radians(c.lat - r.lat) / 2), 2)
            + cos(radians(r.lat)) * cos(radians(c.lat)) * pow(sin(radians(c.lon - r.lon) / 2), 2))) AS h,
          sqrt(pow(r.lat - c.lat, 2) + pow(r.lon - c.lon, 2)) * 111000 AS p, abs(r.lat - c.lat) + abs(r.lon - c.lon) AS m
        FROM pedidos p JOIN restaurantes r ON r.id = p.restaurante_id JOIN clientes c ON c.id = p.usuario_id)""",
    x16_costo_desde_restaurante="""SELECT id, CAST(CASE WHEN h <= 0 THEN 0 ELSE GREATEST(1, FLOOR(h / 1000 / v * 60)) END AS INT)
          + 10 * carga AS costo FROM (
        SELECT p.id, r.velocidad_promedio AS v, r.carga, 2 * 6371000.0::DOUBLE * asin(sqrt(pow(sin(radians(c.lat - r.lat) / 2), 2)
            + cos(radians(r.lat)) * cos(radians(c.lat)) * pow(sin(radians(c.lon - r.lon) / 2), 2))) AS h
        FROM pedidos_entrega p JOIN repartidores r ON r.id = p.restaurante_id JOIN clientes c ON c.id = p.cliente_id)""",
    j09_pedidos_activos="""SELECT p.id, split_part(u.email, '#', 1) AS nombre, 'Item_' || p.menu_id AS item,
        CASE p.estado WHEN 'completado' THEN 'en_ruta' ELSE 'pendiente' END AS estado
        FROM pedidos p JOIN usuarios u ON u.id = p.usuario_id JOIN restaurantes r ON r.id = p.restaurante_id
        WHERE u.rol = 'MACHINERY' AND p.estado IN ('pendiente', 'completado')""",
    q02_huerfanos="""SELECT 'huerfanos' AS control, 'pedidos' AS tabla, 'id' AS columna, COUNT(*) AS observado,
        '= 0' AS limite, COUNT(*) = 0 AS correcto
        FROM pedidos p LEFT JOIN reservas r ON r.pedido_id = p.id WHERE r.id IS NULL""",
    q06_informe=" UNION ALL ".join(
        [f"SELECT 'no_vacia' AS control, '{t}' AS tabla, '' AS columna, COUNT(*) AS observado, '>= 1' AS limite, "
         f"COUNT(*) >= 1 AS correcto FROM {t}" for t in ("usuarios", "restaurantes", "menus", "reservas", "pedidos")]
        + ["""SELECT 'huerfanos', 'pedidos', 'id', COUNT(*), '= 0', COUNT(*) = 0 FROM pedidos p
              WHERE NOT EXISTS (SELECT 1 FROM reservas r WHERE r.pedido_id = p.id)"""]
        + [f"SELECT 'minimo', '{t}', '', COUNT(*), '>= {n}', COUNT(*) >= {n} FROM {t}" for t, n in
           {"dim_usuario": 10, "dim_restaurante": 5, "dim_menu": 20, "hechos_reservas": 50}.items()]
        + [f"SELECT 'requerida', '{t}', '{c}', 1, '= 1', TRUE" for t, cs in
           {"hechos_reservas": ["tiempo_id", "usuario_id", "restaurante_id", "total"],
            "dim_tiempo": ["tiempo_id", "fecha", "ano", "mes", "dia"]}.items() for c in cs]
        + [f"""SELECT 'rango', 'hechos_reservas', '{c}', COUNT(*), '{a}..{b}', COUNT(*) = 0 FROM hechos_reservas
               WHERE {c} < {a} OR {c} > {b}""" for c, a, b in (("total", 0, 10000), ("invitados", 1, 50))]),
    k06_documentos_busqueda="""SELECT id AS _id, CAST(to_json({'id': id, 'titulo': titulo, 'categoria': categoria,
        'activo': activo, 'restaurante_id': restaurante_id, 'updated_at': '2024-01-31T02:00:00'}) AS VARCHAR) AS doc FROM menus""",
    q07_reservas_completas="""WITH cuenta AS (SELECT id AS pedido_id, total, estado AS estado_pedido FROM pedidos),
        vigentes AS (SELECT id AS reserva_id, usuario_id, restaurante_id, timestamp_reserva AS fecha_reserva, estado AS estado_reserva,
            invitados, menu_id, pedido_id FROM reservas WHERE NOT timestamp_reserva < TIMESTAMP '2000-01-31')
        SELECT * EXCLUDE (pedido_id) REPLACE (ifnull(total, 0) AS total, ifnull(estado_pedido, 'sin_pedido') AS estado_pedido)
        FROM vigentes LEFT JOIN cuenta USING (pedido_id)""",
    q08_menus_activos="""SELECT id, titulo, categoria, activo, restaurante_id, restaurante_nombre
        FROM (SELECT id AS restaurante_id, nombre AS restaurante_nombre FROM restaurantes)
        JOIN (FROM menus WHERE activo IS TRUE) USING (restaurante_id)""",
    j12_realizo=REALIZO,
    j12_en_restaurante=EN_REST,
    j12_incluye=INCLUYE,
    j13_incluye_detalle="SELECT * FROM incluye_detalle",
    j13_reservo=RESERVO,
    j11_nombres_de_calle="""SELECT c.id, c.lat, c.lon, MAX(r.nombre) AS nombre
        FROM calle c LEFT JOIN road r ON r.src = c.id AND r.nombre <> '' GROUP BY 1, 2, 3""",
    j17_anclas_con_nodo="""SELECT k.id, k.email AS nombre, k.lat, k.lon, c.id AS osm_node_id, c.lat AS osm_lat, c.lon AS osm_lon
        FROM clientes k JOIN calle c ON c.id = k.id""",
    g01_nodos_por_tipo=_por_tipo("tipo_nodo", {n: f"SELECT * FROM {t}" for n, t in {
        "Usuario": "usuarios", "Restaurante": "restaurantes", "Producto": "menus", "Pedido": "pedidos",
        "Calle": "calle"}.items()}),
    g02_relaciones_por_tipo=_por_tipo("tipo_relacion", {
        "REALIZO": REALIZO, "EN_RESTAURANTE": EN_REST, "INCLUYE": INCLUYE,
        "INCLUYE_DETALLE": "SELECT * FROM incluye_detalle", "RESERVO": RESERVO,
        "RECOMIENDA": "SELECT * FROM recomienda", "ROAD": "SELECT src FROM road UNION ALL SELECT dst FROM road"}),
    g03_estadisticas_grafo=f"""SELECT {_cuenta('usuarios')} AS usuarios, {_cuenta('restaurantes')} AS restaurantes,
        {_cuenta('menus')} AS productos, {_cuenta('pedidos')} AS pedidos, {_cuenta('calle')} AS calles,
        {' + '.join(f'(SELECT COUNT(*) FROM ({q}))' for q in (REALIZO, EN_REST, INCLUYE, 'SELECT * FROM incluye_detalle', RESERVO))}
          AS total_relaciones""",
    g04_estadisticas_vial=f"""SELECT {_cuenta('calle')} AS nodos_osm, {_cuenta('road')} * 2 AS relaciones_osm,
        {_cuenta('restaurantes')} AS restaurantes, {_cuenta('clientes')} AS clientes""",
    g05_caminos_de_vias="""SELECT DISTINCT src, dst, distancia FROM (
        SELECT a.id AS src, b.id AS dst, sqrt((a.lat - b.lat) * (a.lat - b.lat) + (a.lon - b.lon) * (a.lon - b.lon)) * 111000 AS distancia
        FROM calle a JOIN calle b ON abs(b.id - a.id) = 1 AND CAST(FLOOR(a.id / 40) AS INT) = CAST(FLOOR(b.id / 40) AS INT))""",
    g08_cruces_principales=f"""SELECT c.id, c.lat, c.lon, g.n AS conexiones FROM calle c
        JOIN ({GRADOS.format(t='road')}) g ON g.id = c.id ORDER BY 4 DESC, 1 LIMIT 10""",
    g09_conectados_aislados=f"""SELECT CASE WHEN g.n > 0 THEN 'CONECTADO' ELSE 'AISLADO' END AS estado, COUNT(*) AS cantidad
        FROM calle c LEFT JOIN ({GRADOS.format(t='road')}) g ON g.id = c.id GROUP BY 1""",
    g10_conectividad_clientes=f"""SELECT k.id, k.email AS nombre, c.id AS osm_node_id, COALESCE(g.n, 0) AS conexiones,
        CASE WHEN g.n > 0 THEN 'CONECTADO' ELSE 'AISLADO' END AS estado
        FROM clientes k JOIN calle c ON c.id = k.id LEFT JOIN ({GRADOS.format(t='road')}) g ON g.id = c.id""",
    g11_calles_frecuentes="""SELECT nombre AS calle, COUNT(*) * 2 AS frecuencia FROM road WHERE nombre <> ''
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    g11_calles_distintas="SELECT DISTINCT nombre AS calle FROM road WHERE nombre <> '' ORDER BY 1 LIMIT 20",
    g11_estadisticas_nombres="""SELECT COUNT(*) * 2 AS total_relaciones, COUNT(*) FILTER (nombre <> '') * 2 AS con_nombre,
        COUNT(*) FILTER (nombre IS NULL OR nombre = '') * 2 AS sin_nombre,
        ROUND(COUNT(*) FILTER (nombre <> '') * 100.0::DOUBLE / COUNT(*), 2) AS porcentaje_con_nombre FROM road""",
    g12_co_compras="""SELECT p1 AS id1, p2 AS id2, m1.titulo AS prod1, m2.titulo AS prod2, COUNT(*) AS veces,
        CAST(SUM(c1 + c2) AS DOUBLE) / COUNT(*) AS cantidad_promedio
        FROM co JOIN menus m1 ON m1.id = p1 JOIN menus m2 ON m2.id = p2 GROUP BY 1, 2, 3, 4 ORDER BY 5 DESC, 1, 2 LIMIT 5""",
    g13_co_compras_categoria="""SELECT m1.categoria AS cat1, m2.categoria AS cat2, COUNT(*) AS combinaciones
        FROM incluye_detalle a JOIN incluye_detalle b ON a.src = b.src JOIN menus m1 ON m1.id = a.dst
        JOIN menus m2 ON m2.id = b.dst WHERE m1.categoria <> m2.categoria
        GROUP BY 1, 2 HAVING COUNT(*) >= 5 ORDER BY 3 DESC, 1, 2 LIMIT 5""",
    g13_co_compras_categoria_sin_minimo="""SELECT m1.categoria AS cat1, m2.categoria AS cat2, COUNT(*) AS combinaciones
        FROM incluye_detalle a JOIN incluye_detalle b ON a.src = b.src JOIN menus m1 ON m1.id = a.dst
        JOIN menus m2 ON m2.id = b.dst WHERE m1.categoria <> m2.categoria
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
    g14_co_compras_valor="""SELECT p1 AS id1, p2 AS id2, m1.titulo AS titulo1, m2.titulo AS titulo2, COUNT(*) AS frecuencia,
        CAST(SUM(CAST(s1 AS DECIMAL(18,2)) + CAST(s2 AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS valor_promedio
        FROM co JOIN menus m1 ON m1.id = p1 JOIN menus m2 ON m2.id = p2 GROUP BY 1, 2, 3, 4 ORDER BY 5 DESC, 6 DESC, 1, 2 LIMIT 10""",
    g15_co_compras_mismo_restaurante="""SELECT p1 AS id1, p2 AS id2, m1.titulo AS titulo1, m2.titulo AS titulo2, COUNT(*) AS co_compras
        FROM co JOIN menus m1 ON m1.id = p1 JOIN menus m2 ON m2.id = p2 AND m2.restaurante_id = m1.restaurante_id
        GROUP BY 1, 2, 3, 4 ORDER BY 5 DESC, 1, 2 LIMIT 5""",
    # every order has one user, so a user with n orders is the centre of a star: two values per n
    g16_usuarios_influyentes="""WITH RECURSIVE cuenta AS (SELECT u.id, u.email, u.rol, COUNT(o.o_orderkey) AS n
          FROM usuarios u LEFT JOIN orders o ON o.o_custkey = u.id GROUP BY 1, 2, 3),
        paso AS (SELECT DISTINCT n, 0 AS i, 0.15::DOUBLE AS centro, 0.15::DOUBLE AS hoja FROM cuenta
          UNION ALL SELECT n, i + 1, 0.15 + 0.85 * n * hoja, 0.15 + 0.85 * centro / GREATEST(n, 1) FROM paso WHERE i < 20)
        SELECT email, rol, ROUND(centro, 6) AS score FROM cuenta JOIN paso USING (n) WHERE i = 20
        ORDER BY 3 DESC, id LIMIT 10""",
    g17_actividad_usuarios="""SELECT u.email, u.rol, COUNT(*) AS actividad FROM usuarios u JOIN orders ON o_custkey = u.id
        GROUP BY u.id, u.email, u.rol ORDER BY 3 DESC, u.id LIMIT 10""",
    g18_influye_en=_similares("SELECT * FROM compras", 0.05, "productos_comunes"),
    g19_restaurantes_populares="""SELECT r.nombre, r.categoria_local AS categoria, COUNT(p.id) AS total FROM restaurantes r
        LEFT JOIN pedidos p ON p.restaurante_id = r.id GROUP BY r.id, 1, 2 ORDER BY 3 DESC, r.id LIMIT 10""",
    g19_restaurantes_populares_gourmet="""SELECT r.nombre, r.categoria_local AS categoria, COUNT(p.id) AS total FROM restaurantes r
        LEFT JOIN pedidos p ON p.restaurante_id = r.id AND r.categoria_local = 'gourmet'
        GROUP BY r.id, 1, 2 ORDER BY 3 DESC, r.id LIMIT 10""",
    g20_mas_recomiendan=_ranking("src", "total_recomendaciones", "canales_usados"),
    g20_mas_recomendados=_ranking("dst", "veces_recomendado", "canales_recibidos"),
    g21_estadisticas_recomendacion=f"""SELECT {_cuenta('recomienda')} AS total_recomendaciones,
        (SELECT COUNT(DISTINCT src) FROM recomienda) AS usuarios_que_recomiendan,
        (SELECT COUNT(DISTINCT dst) FROM recomienda) AS usuarios_recomendados,
        (SELECT {CANALES} FROM (SELECT canal, COUNT(*) AS n FROM recomienda GROUP BY 1)) AS distribucion_canales""",
    g22_mas_influyentes=f"""SELECT u.email, u.rol, COUNT(*) AS total_influencias, ROUND({SCORE} / COUNT(*), 4) AS score_promedio,
        {B('SUM(productos_comunes)')} AS productos_comunes_total FROM influye i JOIN usuarios u ON u.id = i.src
        GROUP BY u.id, 1, 2 ORDER BY 3 DESC, 4 DESC, u.id LIMIT 10""",
    g23_mas_influidos=f"""SELECT u.email, u.rol, COUNT(*) AS veces_influenciado,
        ROUND({SCORE} / COUNT(*), 4) AS score_promedio_recibido FROM influye i JOIN usuarios u ON u.id = i.dst
        GROUP BY u.id, 1, 2 ORDER BY 3 DESC, 4 DESC, u.id LIMIT 10""",
    g24_estadisticas_influencia=f"""SELECT COUNT(*) AS total_influencias, COUNT(DISTINCT src) AS usuarios_influyentes,
        COUNT(DISTINCT dst) AS usuarios_influenciados, ROUND(MIN(score), 4) AS score_min, ROUND(MAX(score), 4) AS score_max,
        ROUND({SCORE} / COUNT(*), 4) AS score_promedio,
        ROUND(CAST(SUM(productos_comunes) AS DOUBLE) / COUNT(*), 2) AS productos_comunes_promedio FROM influye""",
    g25_cadenas="""WITH r AS (SELECT *, row_number() OVER () AS e FROM recomienda),
        c AS (SELECT 1 AS chain_length, [a.src, a.dst] AS nodos, [a.canal] AS canales, [a.fecha] AS fechas FROM r a
            WHERE a.src <> a.dst
          UNION ALL SELECT 2, [a.src, a.dst, b.dst], [a.canal, b.canal], [a.fecha, b.fecha] FROM r a
            JOIN r b ON b.src = a.dst AND b.e <> a.e WHERE a.src <> b.dst
          UNION ALL SELECT 3, [a.src, a.dst, b.dst, d.dst], [a.canal, b.canal, d.canal], [a.fecha, b.fecha, d.fecha] FROM r a
            JOIN r b ON b.src = a.dst AND b.e <> a.e JOIN r d ON d.src = b.dst AND d.e <> a.e AND d.e <> b.e
            WHERE a.src <> d.dst),
        m AS (SELECT * FROM c ORDER BY chain_length DESC, nodos, canales, fechas LIMIT 10)
        SELECT u0.email || '>' || u1.email || COALESCE('>' || u2.email, '') || COALESCE('>' || u3.email, '') AS cadena,
          chain_length, array_to_string(canales, '>') AS canales, array_to_string(fechas, '>') AS fechas
        FROM m JOIN usuarios u0 ON u0.id = nodos[1] JOIN usuarios u1 ON u1.id = nodos[2]
        LEFT JOIN usuarios u2 ON u2.id = nodos[3] LEFT JOIN usuarios u3 ON u3.id = nodos[4]""",
    g26_cadenas_de_dos="""WITH r AS (SELECT *, row_number() OVER () AS e FROM recomienda),
        m AS (SELECT a.src AS x, a.dst AS y, b.dst AS z FROM r a JOIN r b ON b.src = a.dst AND b.e <> a.e
          WHERE a.src <> b.dst ORDER BY 1, 2, 3, a.canal, b.canal LIMIT 10)
        SELECT ux.email AS inicio, uy.email AS intermedio, uz.email AS fin FROM m JOIN usuarios ux ON ux.id = x
        JOIN usuarios uy ON uy.id = y JOIN usuarios uz ON uz.id = z""",
    g27_mutuas="""SELECT a.src AS usuario1, a.dst AS usuario2, COUNT(*) AS veces FROM recomienda a
        JOIN recomienda b ON b.src = a.dst AND b.dst = a.src GROUP BY 1, 2""",
    g27_mutuas_con_email="""SELECT x.email AS email1, y.email AS email2, n AS veces FROM (
          SELECT ida.src, ida.dst, COUNT(*) AS n FROM recomienda ida
          JOIN recomienda vuelta ON (vuelta.dst, vuelta.src) = (ida.src, ida.dst) GROUP BY ALL) p
        JOIN usuarios x ON x.id = p.src JOIN usuarios y ON y.id = p.dst""",
    g28_influencia_cruzada=f"""WITH x AS ({CRUCE}) SELECT email, rol, r AS recomendaciones, i AS influencias, {TIPO} AS tipo_usuario
        FROM x WHERE r > 0 OR i > 0 ORDER BY 3 DESC, 4 DESC, id LIMIT 15""",
    g28_influencia_cruzada_literal=f"""WITH x AS (SELECT u.id, u.email, u.rol, COUNT(a.src) AS r, COUNT(b.src) AS i FROM usuarios u
          LEFT JOIN recomienda a ON a.src = u.id LEFT JOIN influye b ON b.src = u.id GROUP BY 1, 2, 3)
        SELECT email, rol, r AS recomendaciones, i AS influencias, {TIPO} AS tipo_usuario
        FROM x WHERE r > 0 OR i > 0 ORDER BY 3 DESC, 4 DESC, id LIMIT 15""",
    g29_comunidades="""WITH RECURSIVE s AS (SELECT src, dst FROM recomienda UNION SELECT dst, src FROM recomienda),
        alcanza AS (SELECT id, id AS otro FROM usuarios UNION SELECT a.id, s.dst FROM alcanza a JOIN s ON s.src = a.otro)
        SELECT id, MIN(otro) AS comunidad FROM alcanza GROUP BY 1""",
    g29_calidad_por_ciudad="""WITH e AS (SELECT s.ciudad AS a, d.ciudad AS b FROM recomienda r JOIN usuarios s ON s.id = r.src
          JOIN usuarios d ON d.id = r.dst WHERE r.src <> r.dst),
        t AS (SELECT u.ciudad, COUNT(*) AS miembros, (SELECT COUNT(*) FROM e WHERE a = u.ciudad AND b = u.ciudad) AS d,
            (SELECT COUNT(*) FROM e WHERE a <> b AND u.ciudad IN (a, b)) AS f FROM usuarios u GROUP BY 1)
        SELECT ciudad AS comunidad, miembros, d AS peso_dentro, f AS peso_fuera, ROUND(d::DOUBLE / m
            - ((2 * d + f)::DOUBLE / (2 * m)) * ((2 * d + f)::DOUBLE / (2 * m)), 9) AS modularidad
        FROM t, (SELECT COUNT(*) AS m FROM e)""",
    g30_productos_similares=_similares("SELECT DISTINCT dst AS entidad, src AS item FROM incluye_detalle", 0.04, "pedidos_comunes"),
    g31_recomendar_productos="""WITH v AS (SELECT p1, p2, COUNT(*) AS veces FROM co GROUP BY 1, 2 HAVING COUNT(*) >= 2),
        vec AS (SELECT p1 AS a, p2 AS b, veces FROM v UNION ALL SELECT p2, p1, veces FROM v),
        t AS (SELECT c.entidad AS usuario_id, vec.b AS producto_id, CAST(SUM(veces) AS BIGINT) AS puntos
          FROM compras c JOIN vec ON vec.a = c.item GROUP BY 1, 2),
        n AS (SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM compras c WHERE c.entidad = t.usuario_id AND c.item = t.producto_id))
        SELECT usuario_id, CAST(puesto AS INT) AS puesto, producto_id, puntos FROM (
          SELECT *, row_number() OVER (PARTITION BY usuario_id ORDER BY puntos DESC, producto_id) AS puesto FROM n)
        WHERE puesto <= 5""",
)
