"""Fixed schemas. Nothing in this package infers a schema from data."""

from pyspark.sql import types as T

# One sample of one signal, in event time.
SAMPLES = T.StructType([
    T.StructField("signame", T.StringType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("tie", T.LongType(), False),
    T.StructField("value", T.DoubleType(), False),
])

# A topic record: the CSV message "signame,HH:MM:SS.mmm,value" as bytes.
MESSAGES = T.StructType([T.StructField("value", T.BinaryType(), True)])

# A message that is no sample, with its place in the topic and what is wrong.
REFUSED_MESSAGES = T.StructType([
    T.StructField("message", T.BinaryType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("reason", T.StringType(), True),
])

# The stored table of abnormal beats.
SIGNAL_SAMPLES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("signame", T.StringType(), False),
    T.StructField("time", T.TimestampNTZType(), False),
    T.StructField("ecg", T.ArrayType(T.DoubleType()), True),
    T.StructField("abnormal", T.StringType(), False),
])

# Header of one recording, as decoded from the waveform container.
RECORD_HEADER = T.StructType([
    T.StructField("record", T.StringType(), False),
    T.StructField("fs", T.DoubleType(), True),
    T.StructField("n_sig", T.IntegerType(), True),
    T.StructField("sig_len", T.LongType(), True),
    T.StructField("units", T.ArrayType(T.StringType()), True),
    T.StructField("sig_name", T.ArrayType(T.StringType()), True),
    T.StructField("comments", T.ArrayType(T.StringType()), True),
])
