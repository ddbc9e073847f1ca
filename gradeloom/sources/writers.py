"""Hand-off of prepared tables to a trainer."""


def write_splits(df, path, file_format="parquet", split_column="split"):
    """Write one folder per split, as Parquet or JSON Lines.

    Rows go to the split folders straight from the tasks that hold them: no
    shuffle, and a large split is never gathered in one task.
    """
    df.write.partitionBy(split_column).format(file_format).save(path)


def write_json_lines(df, path):
    df.write.json(path)
