"""Operations of a training-data pipeline: chat formatting, decontamination, language identification, main
text of web pages, licence scans, token counts, duplicate removal and packing.

Nothing else in the library imports this subpackage. Every operator selects the columns it needs before
anything else, so further columns of its input, whatever their names, never clash with its own.
"""
