"""Training-data operators: mixing, chat formatting, token files, de-duplication,
decontamination, page text and language identification on Spark DataFrames."""
