"""Oracle SQL of the readers and writers: what was written must come back."""

from comanda.plans import oraculo_vistas  # noqa: F401  (registers the cubes first)
from comanda.plans.oraculo import _CONSULTAS, registrar
from comanda.plans.oraculo_grafo import REALIZO

registrar(
    s01_restaurantes_csv="SELECT id, nombre, capacidad, categoria_local, lat, lon, true AS sin_telefono FROM restaurantes",
    s02_menus_csv="SELECT id, titulo, categoria, activo, restaurante_id FROM menus",
    s02_menus_dos_ordenes="SELECT id, titulo || chr(10) || categoria AS titulo, categoria, activo, restaurante_id FROM menus",
    k06_documentos_fusionados="""SELECT id AS _id, CAST(to_json({'id': id, 'titulo': titulo, 'categoria': categoria,
        'activo': activo, 'restaurante_id': restaurante_id,
        'updated_at': IF(activo, '2024-02-01T02:00:00', '2024-01-31T02:00:00')}) AS VARCHAR) AS doc FROM menus""",
    k08_grafo_fusionado=f"""SELECT id, IF(pais = 'ASIA', rol, 'sin rol') AS rol, COUNT(r.dst) AS pedidos
        FROM usuarios LEFT JOIN (SELECT DISTINCT src, dst FROM ({REALIZO})) r ON r.src = id GROUP BY id, pais, rol""",
    s03_detalle_opcional="SELECT pedido_id, producto_id, cantidad, precio_unitario FROM pedido_detalle",
    s04_clientes_limitados="""SELECT id, split_part(email, '#', 1) AS nombre
        FROM (SELECT * FROM usuarios ORDER BY id LIMIT 500) WHERE rol = 'MACHINERY'""",
    s05_hechos_guardados="SELECT * FROM hechos_reservas",
    k05_cubo_guardado=_CONSULTAS["a01_ingresos_mes_categoria"],
    s08_mapa_xml="""WITH v AS (SELECT id, lat, lon, id // 40 AS fila FROM calle)
        SELECT a.id AS src, b.id AS dst, 111000 * sqrt(pow(a.lat - b.lat, 2) + pow(a.lon - b.lon, 2)) AS distancia,
        CASE WHEN a.fila % 3 <> 0 THEN 'Via ' || a.fila END AS nombre
        FROM v a JOIN v b ON a.fila = b.fila AND b.id IN (a.id - 1, a.id + 1)""",
    s09_nombres_csv="""SELECT id, lat, lon, (SELECT MAX(nombre) FROM road WHERE src = id AND nombre <> '') AS nombre
        FROM calle""",
    s10_catalogo_reciente="SELECT id, titulo FROM menus WHERE id % 48 >= 12",
    k07_grafo_guardado=f"""SELECT * FROM (SELECT 'Usuario' AS tipo, COUNT(*) AS cantidad FROM customer
        UNION ALL SELECT 'Restaurante', COUNT(*) FROM supplier UNION ALL SELECT 'Producto', COUNT(*) FROM part
        UNION ALL SELECT 'REALIZO', COUNT(*) FROM ({REALIZO})) WHERE cantidad > 0""",
    p07_estados="""SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 2 THEN 'en_ruta' WHEN 3 THEN 'cancelado'
        ELSE 'pendiente' END AS estado FROM orders""",
    p09_listado_restaurantes="SELECT id, nombre, lat, lon FROM restaurantes ORDER BY id",
    p09_listado_clientes="SELECT id, email AS nombre, lat, lon FROM clientes ORDER BY id",
    x01_marcas_de_tiempo="""SELECT id, CASE WHEN id % 13 <> 0 THEN strftime(timestamp_reserva, '%Y-%m-%d %H:%M:%S') END AS cuando
        FROM reservas WHERE timestamp_reserva IS NOT NULL""",
    x10_centimos="""SELECT l_orderkey AS pedido_id, l_partkey AS producto_id,
        floor(CAST(l_quantity AS INT) * 12.5::DOUBLE + 0.5) / 100 AS precio FROM lineitem""",
)
