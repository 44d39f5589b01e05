"""Explicit schemas for every source and target; nothing is inferred in production reads.

Codes that may start with a zero (ZIP, phone, card, area code) are text.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


TEXT, WHOLE, SMALL, AMOUNT, MOMENT = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.TimestampType(),
)

BRANCH_FEED = _fields(
    BRANCH_CODE=WHOLE,
    BRANCH_NAME=TEXT,
    BRANCH_STREET=TEXT,
    BRANCH_CITY=TEXT,
    BRANCH_STATE=TEXT,
    BRANCH_ZIP=TEXT,
    BRANCH_PHONE=TEXT,
    LAST_UPDATED=TEXT,
)
BRANCH = _fields(
    BRANCH_CODE=WHOLE,
    BRANCH_NAME=TEXT,
    BRANCH_STREET=TEXT,
    BRANCH_CITY=TEXT,
    BRANCH_STATE=TEXT,
    BRANCH_ZIP=TEXT,
    BRANCH_PHONE=TEXT,
    LAST_UPDATED=MOMENT,
)

TRANSACTION_FEED = _fields(
    TRANSACTION_ID=WHOLE,
    CREDIT_CARD_NO=TEXT,
    DAY=SMALL,
    MONTH=SMALL,
    YEAR=SMALL,
    CUST_SSN=WHOLE,
    BRANCH_CODE=WHOLE,
    TRANSACTION_TYPE=TEXT,
    TRANSACTION_VALUE=AMOUNT,
)
TRANSACTION = _fields(
    TRANSACTION_ID=WHOLE,
    CREDIT_CARD_NO=TEXT,
    TIMEID=TEXT,
    CUST_SSN=WHOLE,
    BRANCH_CODE=WHOLE,
    TRANSACTION_TYPE=TEXT,
    TRANSACTION_VALUE=AMOUNT,
)

CUSTOMER_FEED = _fields(
    CREDIT_CARD_NO=TEXT,
    SSN=WHOLE,
    CUST_EMAIL=TEXT,
    CUST_PHONE=TEXT,
    FIRST_NAME=TEXT,
    MIDDLE_NAME=TEXT,
    LAST_NAME=TEXT,
    APT_NO=TEXT,
    STREET_NAME=TEXT,
    CUST_CITY=TEXT,
    CUST_ZIP=TEXT,
    CUST_STATE=TEXT,
    CUST_COUNTRY=TEXT,
    LAST_UPDATED=TEXT,
)
CUSTOMER = _fields(
    SSN=WHOLE,
    FIRST_NAME=TEXT,
    MIDDLE_NAME=TEXT,
    LAST_NAME=TEXT,
    CREDIT_CARD_NO=TEXT,
    FULL_STREET_ADDRESS=TEXT,
    CUST_CITY=TEXT,
    CUST_STATE=TEXT,
    CUST_COUNTRY=TEXT,
    CUST_ZIP=TEXT,
    CUST_PHONE=TEXT,
    CUST_EMAIL=TEXT,
    LAST_UPDATED=MOMENT,
)

CROSSWALK = _fields(
    CUST_ZIP=TEXT,
    CUST_STATE=TEXT,
    CUST_CITY=TEXT,
    CUST_COUNTY=TEXT,
    AREA_CODE=TEXT,
    TIME_ZONE=TEXT,
    DST=TEXT,
)

LOAN = _fields(
    Application_ID=TEXT,
    Application_Status=TEXT,
    Credit_History=WHOLE,
    Dependents=TEXT,
    Education=TEXT,
    Gender=TEXT,
    Income=TEXT,
    Married=TEXT,
    Property_Area=TEXT,
    Self_Employed=TEXT,
)

GEOJSON = _fields(
    type=TEXT,
    features=T.ArrayType(_fields(type=TEXT, properties=_fields(name=TEXT))),
)

CHANGE_REQUEST = _fields(REQUEST_ID=WHOLE, CREDIT_CARD_NO=TEXT, FIELD=TEXT, NEW_VALUE=TEXT)
