"""Table schemas."""

from pyspark.sql import types as T

POST = T.StructType([
    T.StructField("upload_date", T.DateType()),
    T.StructField("upload_time", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("comments", T.StringType()),
    T.StructField("num_views", T.LongType()),
    T.StructField("num_likes", T.LongType()),
    T.StructField("community", T.StringType()),
    T.StructField("car_name", T.StringType()),
    T.StructField("issue", T.StringType()),
    T.StructField("url", T.StringType()),
])

CRAWL = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("Date", "Time", "Title", "Body", "Comment", "View", "Like", "Community", "CarName", "Url")
])

CRAWL_ARCHIVE = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("Date", "Time", "Title", "Body", "Comment", "View", "Like", "Community", "Url",
                 "NumComments", "DcApp", "Dislike")
])

NEWS_CRAWL = T.StructType([
    T.StructField(name, T.StringType()) for name in ("upload_date", "upload_time", "title", "body", "url")
])

NEWS = T.StructType([
    T.StructField("upload_date", T.DateType()),
    T.StructField("upload_time", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("car_name", T.StringType()),
    T.StructField("issue", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("is_trigger", T.BooleanType()),
])

DICTIONARY = T.StructType([
    T.StructField("defect_type", T.StringType()),
    T.StructField("keywords", T.ArrayType(T.StringType())),
])

KNOWN_CASES = T.StructType([
    T.StructField("car_name", T.StringType()),
    T.StructField("defect_type", T.StringType()),
    T.StructField("keywords", T.ArrayType(T.StringType())),
    T.StructField("news_dates", T.ArrayType(T.StringType())),
])

SERIES = "array<struct<upload_date:date,norm_graph_score:double>>"
