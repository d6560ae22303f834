"""Reading raw files and reference tables, staging them, and writing reports."""
