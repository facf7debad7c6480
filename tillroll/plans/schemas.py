"""Columns of the sources and of the published targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.files import text_schema

# Source column names.
RECEIPTS = text_schema(
    [
        "SBLP_TRANSACTION_ID", "LOYALTY_ID", "PRODUCTS", "BASE_POINT_VALUE", "MOBILE_UID",
        "MOBILE_OS", "RECEIPT_STATUS", "MSG_CODE",
    ]
)
CONSUMERS = text_schema(
    [
        "REGIS_CNSM_ID", "REGIS_CTY_CODE", "REGIS_ID", "REGIS_LTY_ID", "REGIS_DATE",
        "REGIS_CHANNEL", "REGIS_GENDER", "REGIS_CITY", "CHILD_ID", "CHILD_NB", "CHILD_GENDER",
    ]
)
ADDRESS_FIELDS = ["street", "city", "state"]
ADDRESSES = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("consumer_id", T.StringType()),
        T.StructField("address", text_schema(ADDRESS_FIELDS)),
    ]
)
# Sources as they are staged; addresses flat and without their id.
STAGED = {
    "OL": RECEIPTS,
    "CP": CONSUMERS,
    "ADDR": text_schema(["consumer_id", *ADDRESS_FIELDS]),
}

# Target column names, in order. A type is enforced where the target's query
# states one; None keeps the type the source has.
REGISTRATION_DIM = {
    "REGIS_KEY": "bigint",
    "CNSM_ID": None,
    "CTY_CODE": "smallint",
    "REGIS_ID": "int",
    "REGIS_DATE": None,
    "LTY_ID": None,
    "REGIS_CHANNEL": None,
    "REGIS_GENDER": None,
    "REGIS_CITY": None,
    "Street": None,
    "City": None,
    "State": None,
    "INS_DT": "date",
}
CHILD_DIM = {
    "CHILD_KEY": "bigint",
    "REGIS_CNSM_ID": None,
    "REGIS_CTY_CODE": None,
    "CHILD_ID": None,
    "CHILD_NB": None,
    "CHILD_GENDER": None,
    "INS_DT": "date",
}
TRANSACTION_FACT = {
    "RTL_TXN_KEY": "bigint",
    "TXN_ID": "string",
    "TXN_ITEM_QTY": "int",
    "TXN_LOY_VAL_STD_CCY": None,
    "TXN_GROSS_MNY_STD_CCY": "int",
    "TXN_GROSS_MNY_LCL_CCY": None,
    "MNY_LCL_CCY_TYPE_KEY": "int",
    "RTL_TXN_TYPE_KEY": None,
    "TXN_TS": None,
    "TXN_DT_KEY": "date",
    "TXN_TM_HOUR": "int",
    "TXN_TM_MINUTE": "int",
    "TXN_TM_SECOND": "int",
    "CHNL_KEY": "string",
    "CNSM_ID": None,
    "RTL_TXN_EXT_DEC_1": None,
    "RTL_TXN_EXT_DEC_2": None,
    "RTL_TXN_EXT_DEC_3": None,
    "RTL_TXN_EXT_CHAR_1": None,
    "RTL_TXN_EXT_CHAR_2": None,
    "RTL_TXN_EXT_CHAR_3": None,
    "RTL_TXN_EXT_CHAR_4": None,
    "RTL_TXN_EXT_CHAR_5": "bigint",
    "INS_DT": "date",
}


def publish(df: DataFrame, columns: dict[str, str | None]) -> DataFrame:
    """Exactly the published columns, in order, in the published types."""
    return df.select(
        *(
            (F.col(name) if to is None else F.col(name).cast(to)).alias(name)
            for name, to in columns.items()
        )
    )
