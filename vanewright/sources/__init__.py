"""Reading landing files and tables, writing bronze tables, versions and result sinks."""
