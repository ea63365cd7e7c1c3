"""Column functions: everything here stays in the JVM except the splitter and the table renderer."""
