"""Distributor feed layouts (C-1): sheet, header row, column map, formats.

A profile only *describes* a layout; ``sources.grid.read_profile`` turns a
raw-grid table into canonical columns with it.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Profile:
    code: str
    name: str
    sheet: str | None                 # None with multi_sheet: all sheets with zone_prefix
    header_row: int                   # 0-based row index of the header
    columns: tuple[tuple[str, str], ...]   # (header text, canonical column)
    date_fmt: str | None = None       # None = try common layouts
    decimal_sep: str = "."
    multi_sheet: bool = False
    zone_prefix: str | None = None
    city_zone_combined: bool = False
    city_zone_sep: str = " / "
    extra: dict = field(default_factory=dict)

    @property
    def headers(self) -> list[str]:
        return [h for h, _ in self.columns]


# FIXED VALUES: the six distributor layouts (header text -> canonical column).
PROFILES: dict[str, Profile] = {
    "DIST_A": Profile("DIST_A", "Distribuidora Ramos", "Ventas", 0, (
        ("Fecha", "sale_date"), ("Num_Factura", "invoice_number"), ("Cod_Producto", "dist_product_code"),
        ("Descripcion", "product_name_raw"), ("Cantidad", "quantity"), ("Precio_Unit", "unit_price"),
        ("Descuento_Pct", "discount_pct"), ("Total_Neto", "net_amount"), ("Cliente", "client_name_raw"),
        ("Ciudad", "city_name_raw"), ("Zona", "zone_code_raw"))),
    "DIST_B": Profile("DIST_B", "MediFar Dominicana", "Detalle", 0, (
        ("FECHA", "sale_date"), ("FACTURA", "invoice_number"), ("COD_MF", "dist_product_code"),
        ("PRODUCTO", "product_name_raw"), ("CLIENTE", "client_name_raw"), ("CANT", "quantity"),
        ("PRECIO", "unit_price"), ("IMPORTE", "net_amount"), ("PROV", "city_name_raw"))),
    "DIST_C": Profile("DIST_C", "Farmacorp", "Hoja1", 3, (
        ("fecha", "sale_date"), ("numero_doc", "invoice_number"), ("codigo_fc", "dist_product_code"),
        ("descripcion_prod", "product_name_raw"), ("qty", "quantity"), ("precio_venta", "unit_price"),
        ("total", "net_amount"), ("nombre_cliente", "client_name_raw"), ("ciudad_cliente", "city_name_raw"),
        ("descuento", "discount_pct_raw"))),
    "DIST_D": Profile("DIST_D", "AlphaFarma Group", None, 0, (
        ("Fecha", "sale_date"), ("Factura", "invoice_number"), ("Codigo", "dist_product_code"),
        ("Producto", "product_name_raw"), ("Categoria", "category_raw"), ("Cliente", "client_name_raw"),
        ("TipoCliente", "client_type_raw"), ("Ciudad", "city_name_raw"), ("Cantidad", "quantity"),
        ("PVP", "unit_price"), ("Neto", "net_amount")), multi_sheet=True, zone_prefix="Zona_"),
    "DIST_E": Profile("DIST_E", "BioPharma Distribution", "ReporteVentas", 5, (
        ("Fecha_Venta", "sale_date"), ("ID_Factura", "invoice_number"), ("CodBP", "dist_product_code"),
        ("Nombre_Medicamento", "product_name_raw"), ("Unidades", "quantity"), ("Precio", "unit_price"),
        ("Descto_Pct", "discount_pct"), ("Importe_Neto", "net_amount"), ("Razon_Social", "client_name_raw"),
        ("Municipio", "city_name_raw"), ("Lab", "lab_code_raw"), ("Categoria_Terapeutica", "category_raw"))),
    "DIST_F": Profile("DIST_F", "MedDist Nacional", "Ventas_MedDist", 0, (
        ("Fecha", "sale_date"), ("Referencia", "invoice_number"), ("CodMD", "dist_product_code"),
        ("Medicamento", "product_name_raw"), ("ClienteNombre", "client_name_raw"),
        ("Ciudad_Zona", "city_zone_combined"), ("Unidades", "quantity"), ("Precio_Unit", "unit_price"),
        ("Importe", "net_amount"), ("Margen_Aprox", "margin_pct_raw")),
        date_fmt="dd/MM/yyyy", decimal_sep=",", city_zone_combined=True),
}

NUMERIC_COLUMNS = ("quantity", "unit_price", "net_amount", "gross_amount", "discount_pct", "margin_pct")
PERCENT_COLUMNS = ("discount_pct", "discount_pct_raw", "margin_pct_raw")
