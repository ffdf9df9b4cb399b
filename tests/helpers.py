"""Tiny typed frames for unit tests."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

D = dt.date
M = Decimal

ACCOUNTS = T.StructType([
    T.StructField("data_actual_date", T.DateType()), T.StructField("data_actual_end_date", T.DateType()),
    T.StructField("account_rk", T.LongType()), T.StructField("account_number", T.StringType()),
    T.StructField("char_type", T.StringType()), T.StructField("currency_rk", T.IntegerType()),
    T.StructField("currency_code", T.StringType())])
BALANCES = T.StructType([
    T.StructField("on_date", T.DateType()), T.StructField("account_rk", T.LongType()),
    T.StructField("currency_rk", T.IntegerType()), T.StructField("balance_out", T.DecimalType(23, 8))])
POSTINGS = T.StructType([
    T.StructField("oper_date", T.DateType()), T.StructField("credit_account_rk", T.LongType()),
    T.StructField("debet_account_rk", T.LongType()), T.StructField("credit_amount", T.DecimalType(23, 8)),
    T.StructField("debet_amount", T.DecimalType(23, 8))])
RATES = T.StructType([
    T.StructField("data_actual_date", T.DateType()), T.StructField("data_actual_end_date", T.DateType()),
    T.StructField("currency_rk", T.IntegerType()), T.StructField("reduced_cource", T.DecimalType(18, 8)),
    T.StructField("code_iso_num", T.StringType())])
LEDGER = T.StructType([
    T.StructField("chapter", T.StringType()), T.StructField("ledger_account", T.IntegerType()),
    T.StructField("characteristic", T.StringType()), T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType())])


def frame(spark, schema, data):
    return spark.createDataFrame(data, schema)
