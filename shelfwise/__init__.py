"""Spark-native preparation of catalogue tables for modelling.

Every step takes DataFrames and returns a DataFrame (or a fitted
``pyspark.ml`` model), uses built-in expressions only, and holds under ANSI
mode. ``shelfwise.plans.records`` strings the steps together.
"""
