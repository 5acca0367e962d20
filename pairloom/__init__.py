"""Preparation, distribution and scoring of fine-tuning data as Spark jobs.

Every operator takes and returns DataFrames (or Columns); nothing here keeps
global state and nothing collects rows whose number grows with the data.
"""
