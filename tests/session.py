from pyspark.sql import SparkSession


def make_session(cpus: str = "8") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("raregrain")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
