"""tideline: behaviour and order analytics written as Spark jobs."""
