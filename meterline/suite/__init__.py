"""Every operator as a query over the supplied tables, with the SQL that checks it."""
