SF = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")
