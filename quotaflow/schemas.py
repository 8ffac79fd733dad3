"""Declared schemas and the column names of each input dialect.

Operators only ever see the canonical names below.  A dialect says what a
source file calls each canonical column; reading renames, exporting renames
back.  Nothing is inferred from data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Volume and money stay decimal so that totals are exact and do not depend on
# the order in which partial sums arrive.  Ten places and 18 digits before them;
# a sum has ten digits more.
AMOUNT = T.DecimalType(28, 10)

SALES = T.StructType(
    [
        T.StructField("client_id", T.LongType()),
        T.StructField("material_id", T.LongType()),
        T.StructField("is_b2b", T.BooleanType()),
        T.StructField("volume_hl", AMOUNT),
        T.StructField("revenue", AMOUNT),
        T.StructField("sale_date", T.DateType()),
        T.StructField("packaging_code", T.LongType()),
        T.StructField("brand_code", T.LongType()),
        T.StructField("brand", T.StringType()),
        T.StructField("material", T.StringType()),
        T.StructField("postal_code", T.StringType()),
    ]
)

TARGETS = T.StructType(
    [
        T.StructField("brand", T.StringType()),
        T.StructField("target_volume", T.LongType()),
        T.StructField("target_year", T.IntegerType()),
    ]
)

GEOGRAPHY = T.StructType(
    [
        T.StructField("postal_code", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
    ]
)

# The column names of the source files, by dialect.
SALES_DIALECTS = {
    "local": {
        "Código do Cliente": "client_id",
        "cod material": "material_id",
        "b2b_status": "is_b2b",
        "volume_hl": "volume_hl",
        "valor": "revenue",
        "data_doc": "sale_date",
        "materialPackaging": "packaging_code",
        "brand": "brand_code",
        "brand_desc": "brand",
        "material": "material",
        "CEP_cliente": "postal_code",
    },
    "notebook": {
        "client_id": "client_id",
        "date": "sale_date",
        "brand": "brand",
        "volume_hl": "volume_hl",
        "b2b_status": "is_b2b",
        "cep": "postal_code",
        "valor": "revenue",
    },
}
TARGETS_DIALECT = {"Marca": "brand", "Meta": "target_volume", "Ano": "target_year"}

# The column names of the exported tables.
EXPORT_NAMES = {
    "client_key": "sk_cliente",
    "product_key": "sk_produto",
    "time_key": "sk_tempo",
    "client_id": "cliente_id",
    "postal_code": "cep",
    "city": "cidade",
    "state": "estado",
    "brand": "marca",
    "revenue": "valor",
    "is_b2b": "b2b_status",
    "sale_date": "data",
    "year": "ano",
    "month": "mes",
    "quarter": "trimestre",
    "year_month": "ano_mes",
    "last_purchase": "data_ultima_compra",
    "avg_volume_3m": "volume_medio_3m",
    "avg_volume_6m": "volume_medio_6m",
    "b2b_share_3m": "share_b2b_3m",
    "b2b_share_6m": "share_b2b_6m",
    "target_year": "ano_meta",
    "client_volume": "volume_cliente_marca",
    "brand_volume": "volume_total_marca",
    "share_pct": "percentual_participacao",
    "target_volume": "meta_marca",
    "client_target": "meta_cliente",
}

# The texts that stand for a missing piece of information.
NOT_INFORMED = "Não informado"
NOT_FOUND = "Não encontrado"
NOT_CONSULTED = "Não consultado"

DEFAULT_YEAR = 2025
ESTIMATED_PRICE = 100

# The names of the exported tables.
# Where the notebook variant names a table's columns otherwise, and what it leaves out.
NOTEBOOK_NAMES = {
    "dim_time": {"sale_date": "date"},
    "client_targets": {"client_volume": "volume_total"},
}
NOTEBOOK_DROPS = {"client_targets": ("target_year", "brand_volume")}

TABLE_NAMES = {
    "customer_view": "visao_consolidada",
    "client_targets": "metas_por_cliente",
    "dim_client": "dim_cliente",
    "dim_product": "dim_produto",
    "dim_time": "dim_tempo",
    "fact_sales": "fato_vendas",
}


def export_names(table: str, notebook: bool) -> dict[str, str]:
    """Our column names to the exported ones, for a table of a variant."""
    return EXPORT_NAMES | (NOTEBOOK_NAMES.get(table, {}) if notebook else {})
