"""The extraction as a streaming query over a folder of dumps."""
