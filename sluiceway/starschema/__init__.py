"""The relations of this library as views of a TPC-H-like star schema, with a
query per operator and the same query in SQL to check it against."""
