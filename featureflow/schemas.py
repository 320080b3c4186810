"""Fixed record layouts of the two use cases, and their label dimension."""

from pyspark.sql import types as T

KINDS = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def record(fields: str) -> T.StructType:
    """Schema from ``name type`` pairs; unlike a DDL parse it needs no session."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in pairs])


# Column names, order and types of the interchange formats.
IRIS_FEATURES = ["sepal_length", "sepal_width", "petal_length", "petal_width"]

IRIS_FEATURES_SCHEMA = T.StructType([T.StructField(name, T.DoubleType()) for name in IRIS_FEATURES])

IRIS_SCHEMA = T.StructType(IRIS_FEATURES_SCHEMA.fields + [T.StructField("species", T.StringType())])

IRIS_CLASSES = [(0, "Iris-setosa"), (1, "Iris-versicolor"), (2, "Iris-virginica")]
IRIS_CLASSES_SCHEMA = "iris_id int, iris_value string"

# Column names, order and types of the churn table, and its labels.
CHURN_SCHEMA = record(
    """
    CLIENTNUM int,
    Attrition_Flag string,
    Customer_Age int,
    Gender string,
    Dependent_count int,
    Education_Level string,
    Marital_Status string,
    Income_Category string,
    Card_Category string,
    Months_on_book int,
    Total_Relationship_Count int,
    Months_Inactive_12_mon int,
    Contacts_Count_12_mon int,
    Credit_Limit double,
    Total_Revolving_Bal int,
    Avg_Open_To_Buy double,
    Total_Amt_Chng_Q4_Q1 double,
    Total_Trans_Amt int,
    Total_Trans_Ct int,
    Total_Ct_Chng_Q4_Q1 double,
    Avg_Utilization_Ratio double,
    Naive_Bayes_Classifier_Attrition_Flag_Card_Category_Contacts_Count_12_mon_Dependent_count_Education_Level_Months_Inactive_12_mon_1 double,
    Naive_Bayes_Classifier_Attrition_Flag_Card_Category_Contacts_Count_12_mon_Dependent_count_Education_Level_Months_Inactive_12_mon_2 double
    """
)

CHURN_NEGATIVE = "Existing Customer"
CHURN_POSITIVE = "Attrited Customer"
