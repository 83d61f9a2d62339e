"""Views of the test tables as loan-portfolio entities, with the SQL twins the results are checked against."""
